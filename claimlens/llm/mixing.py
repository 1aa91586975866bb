"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Targets: all sources together get ``total_share`` of all words, shared by weight; a source's target stops
at ``most`` times its own words, and the excess is shared again by weight.

Draws: a keyed hash of the id puts the documents of a source into a fixed random order, which is cut into blocks
of about ``block_words``. A source is taken whole as often as its target allows, then once more up to
the document where its words come nearest to the target. Every block taken is one draw; a source's
number of draws is its quota.

Shards: the quotas of all sources are split among the output shards by a binary tree. At each node the
share of the left half is a multivariate hypergeometric draw, source by source, so the composition of
each shard is that of a uniform shuffle of all draws, and quotas are met exactly. A source's draws, put
in another order by an affine permutation, are then dealt to its shards in disjoint runs, and each
shard is shuffled locally by a keyed hash. All randomness comes from hashes: reruns agree.

Defined results: size is the number of words, null text: 0. Sources are ordered by code point, null
last, and a null source is a source like any other. A document without words is taken as often as
its source, at no cost; a source without words has target 0 and is not taken at all. Equal ids (repeated
rows, null ids) share one place in the order and are taken together. An empty table gives no rows.
Other columns are carried along by ``mix``; helper columns have names of their own (``__mix_*``).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens.llm.base import WORD, stored, text_of

WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MOST = 2
BLOCK_WORDS = 1 << 16
SHARD_WORDS = 1 << 23

SOURCE, SIZE, PLACE, BLOCK, ROW = "__mix_source", "__mix_size", "__mix_place", "__mix_block", "__mix_row"
BITS = 60


def sixty_bits(seed: str, *parts: Column) -> Column:
    """60 hash bits of the parts as a long: the first 15 hex digits of SHA-256."""
    return F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), *parts), 256), 1, 15), 16, 10).cast("long")


def uniform(seed: str, *parts: Column) -> Column:
    return (sixty_bits(seed, *parts) + F.lit(0.5)) / F.lit(float(1 << BITS))


def source_key(source: str) -> Column:
    """A text key that is never null and sorts like the source, null last."""
    name = F.col(source).cast("string")
    return F.when(name.isNull(), F.lit("n")).otherwise(F.concat(F.lit("b"), name))


def with_keys(df: DataFrame, id: str, text: str, source: str, seed: str) -> DataFrame:
    return df.withColumns(
        {
            SOURCE: source_key(source),
            SIZE: F.regexp_count(text_of(text), F.lit(WORD)).cast("long"),
            PLACE: sixty_bits(seed, F.coalesce(F.col(id).cast("string"), F.lit("null"))),
        }
    )


def source_targets(
    keyed: DataFrame, weights: tuple[int, ...] = WEIGHTS, total_share: float = TOTAL_SHARE, most: int = MOST
) -> DataFrame:
    """One row per source: source_size, target."""
    sizes = keyed.groupBy(SOURCE).agg(F.sum(SIZE).alias("source_size"))
    number = F.row_number().over(W.orderBy(SOURCE)) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(number, F.lit(len(weights))) + 1).cast("int"))
    cap = (F.col("source_size") * most).cast("double")
    total = (F.sum("source_size").over(W.partitionBy()) * F.lit(total_share)).cast("double")
    ranked = sizes.withColumn("weight", weight).withColumn("cap", cap).withColumn("total", total)
    # In ascending order of cap per weight the capped sources come first: one is capped if what is left
    # after those before it, shared by weight among the rest, reaches its cap.
    up = W.orderBy(F.col("cap") / F.col("weight"), SOURCE)
    all_rows = W.partitionBy()
    level = (F.col("total") - F.coalesce(F.sum("cap").over(up.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))) / F.sum(
        "weight"
    ).over(up.rowsBetween(0, W.unboundedFollowing))
    ranked = ranked.withColumn("capped", F.col("cap") <= level * F.col("weight"))
    taken = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(all_rows), F.lit(0.0))
    free = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(all_rows)
    final = F.when(F.col("capped"), F.col("cap")).otherwise((F.col("total") - taken) / free * F.col("weight"))
    return ranked.withColumn("target", final).select(SOURCE, "source_size", "target")


def plan_sources(keyed: DataFrame, targets: DataFrame, block_words: int) -> tuple[DataFrame, DataFrame]:
    """Sources with passes, last place of the extra pass and block bits; their blocks in order.

    The prefix sums over a source's blocks go in two levels, and only the one block of a source in which its
    target falls is looked at document by document: no task ever gets a whole source.
    """
    # Blocks per source: a power of two, so that a block is the leading bits of the place.
    wanted = F.greatest(F.col("source_size") / F.lit(float(block_words)), F.lit(1.0))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = targets.withColumns(
        {"bits": F.ceil(F.log2(wanted)).cast("int"), "passes": passes}
    ).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    narrow = keyed.select(SOURCE, SIZE, PLACE).join(sources, SOURCE).withColumn(BLOCK, block_of())
    blocks = narrow.groupBy(SOURCE, BLOCK, "rest").agg(F.sum(SIZE).alias("words")).withColumn(
        "group", F.shiftright(BLOCK, 10)
    )
    totals = blocks.groupBy(SOURCE, "group").agg(F.sum("words").alias("words"), F.count("*").alias("n"))
    earlier = W.partitionBy(SOURCE).orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        SOURCE,
        "group",
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
    )
    within = W.partitionBy(SOURCE, "group").orderBy(BLOCK)
    blocks = (
        blocks.withColumn("inside", F.sum("words").over(within.rowsBetween(W.unboundedPreceding, 0)) - F.col("words"))
        .withColumn("number", F.row_number().over(within) - 1)
        .join(offsets, [SOURCE, "group"])
        .select(
            SOURCE,
            BLOCK,
            "rest",
            "words",
            (F.col("inside") + F.col("words_before")).alias("before"),
            (F.col("number") + F.col("n_before")).alias("number"),
        )
    )
    # Cached by writing: the tree, the cut and the rows all read it.
    blocks = stored(blocks, "blocks")
    crossing = blocks.where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
    by_place = W.partitionBy(SOURCE).orderBy(PLACE)
    cuts = (
        narrow.select(SOURCE, BLOCK, PLACE, SIZE)
        .join(crossing.select(SOURCE, BLOCK, "before", "rest"), [SOURCE, BLOCK])
        .groupBy(SOURCE, PLACE, "before", "rest")
        .agg(F.sum(SIZE).alias("words"))
        .withColumn("end", F.col("before") + F.sum("words").over(by_place.rowsBetween(W.unboundedPreceding, 0)))
        .where(F.col("end") - F.col("words") / 2 <= F.col("rest"))
        .groupBy(SOURCE)
        .agg(F.max(PLACE).alias("cut_place"))
    )
    # A source whose extra pass ends between two blocks, or before the first document of the crossing one.
    full = (
        blocks.where((F.col("before") + F.col("words") <= F.col("rest")) & (F.col("rest") > 0))
        .groupBy(SOURCE)
        .agg(F.max(BLOCK).alias("full_block"))
    )
    sources = sources.join(cuts, SOURCE, "left").join(full, SOURCE, "left")
    full_place = (F.col("full_block") + 1) * power(F.lit(BITS) - F.col("bits")) - 1
    sources = sources.withColumn(
        "last_place", F.greatest(F.coalesce("cut_place", F.lit(-1)), F.coalesce(full_place, F.lit(-1)))
    ).select(SOURCE, "source_size", "target", "passes", "bits", "last_place")
    return stored(sources, "sources"), blocks


def power(bits: Column) -> Column:
    return F.pow(F.lit(2.0), bits).cast("long")


def block_of() -> Column:
    """Leading ``bits`` of the place."""
    return F.floor(F.col(PLACE) / power(F.lit(BITS) - F.col("bits"))).cast("long")


# --- the tree ---------------------------------------------------------------------


def log_factorial(x: Column) -> Column:
    """Stirling's series after seven steps of the recurrence."""
    z = x.cast("double") + 1.0
    steps = reduce(lambda a, b: a * b, [z + float(i) for i in range(7)])
    w = z + 7.0
    return (w - 0.5) * F.log(w) - w + 0.5 * math.log(2 * math.pi) + 1.0 / (w * 12.0) - 1.0 / (w * w * w * 360.0) - F.log(steps)


def log_choose(n: Column, k: Column) -> Column:
    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def hypergeometric(quota: Column, all: Column, drawn: Column, u: Column) -> Column:
    """How many of ``quota`` marked among ``all`` are in ``drawn`` draws without replacement: inversion at ``u``.

    Starts at the mode, where the chance can't underflow, and goes up from there, then down. Looks at twelve standard
    deviations and twelve more on either side; what lies outside has a chance below 1e-30.
    """
    marked, n, taken = (c.cast("double") for c in (quota, all, drawn))
    spare = n - marked - taken
    share = marked / F.greatest(n, F.lit(1.0))
    variance = taken * share * (1.0 - share) * (n - taken) / F.greatest(n - 1.0, F.lit(1.0))
    width = F.sqrt(variance) * 12.0 + 12.0
    least, most = F.greatest(F.lit(0).cast("long"), drawn - (all - quota)), F.least(quota, drawn)
    mode = F.greatest(least, F.least(most, F.floor((taken + 1.0) * (marked + 1.0) / (n + 2.0))))
    low, high = F.greatest(least, F.floor(mode - width)), F.least(most, F.ceil(mode + width))
    first = F.exp(log_choose(quota, mode) + log_choose(all - quota, drawn - mode) - log_choose(all, drawn))

    def chance(acc: Column, k: Column) -> Column:
        """Of k, from that of the value before it in the order."""
        up = (marked - k + 1) * (taken - k + 1) / F.greatest(k * (spare + k), F.lit(1.0))
        down = (k + 1) * (spare + k + 1) / F.greatest((marked - k) * (taken - k), F.lit(1.0))
        before = F.when(k == acc["mode"] - 1, acc["first"]).otherwise(acc["p"])
        return F.when(k == acc["mode"], acc["first"]).when(k > acc["mode"], acc["p"] * up).otherwise(before * down)

    def step(acc: Column, k: Column) -> Column:
        p = chance(acc, k)
        return F.struct(
            acc["mode"].alias("mode"),
            acc["first"].alias("first"),
            p.alias("p"),
            (acc["sum"] + p).alias("sum"),
            F.coalesce(acc["at"], F.when(acc["sum"] + p >= u, k)).alias("at"),
        )

    below = F.when(mode > low, F.sequence(mode - 1, low, F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(
        F.concat(F.sequence(mode, high), below),
        F.struct(
            mode.alias("mode"),
            first.alias("first"),
            F.lit(0.0).alias("p"),
            F.lit(0.0).alias("sum"),
            F.lit(None).cast("long").alias("at"),
        ),
        step,
        lambda acc: F.coalesce(acc["at"], acc["mode"]),  # what rounding leaves
    )


def side(lo: str, hi: str, source: Column, quota: Column) -> Column:
    return F.struct(F.col(lo).alias("lo"), F.col(hi).alias("hi"), source.alias(SOURCE), quota.alias("quota"))


def split_quotas(quotas: DataFrame, shards: int, seed: str) -> DataFrame:
    """Shard, source, count: the leaves of the tree over ``shards``. ``quotas``: source, quota."""
    nodes = quotas.select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), SOURCE, "quota")
    for level in range(max(0, math.ceil(math.log2(shards)))):
        leaf = F.col("hi") - F.col("lo") == 1
        gathered = (
            nodes.where(~leaf)
            .groupBy("lo", "hi")
            .agg(F.array_sort(F.collect_list(F.struct(SOURCE, "quota"))).alias("qs"), F.sum("quota").alias("all"))
            .withColumn("mid", F.floor((F.col("lo") + F.col("hi")) / 2).cast("int"))
            .withColumn("left", F.floor(F.col("all") * (F.col("mid") - F.col("lo")) / (F.col("hi") - F.col("lo"))))
        )
        start = F.struct(
            F.col("all").alias("all"),
            F.col("left").alias("left"),
            F.array().cast(f"array<struct<{SOURCE}:string,quota:bigint,left:bigint>>").alias("out"),
        )

        def step(acc: Column, q: Column) -> Column:  # used at once, with this level
            u = uniform(seed, F.lit(level).cast("string"), F.col("lo").cast("string"), q[SOURCE])
            # An array of one, so that the draw is computed once.
            draw = F.array(hypergeometric(q["quota"], acc["all"], acc["left"], u))
            return F.element_at(
                F.transform(
                    draw,
                    lambda k: F.struct(
                        (acc["all"] - q["quota"]).alias("all"),
                        (acc["left"] - k).alias("left"),
                        F.concat(
                            acc["out"],
                            F.array(F.struct(q[SOURCE].alias(SOURCE), q["quota"].alias("quota"), k.alias("left"))),
                        ).alias("out"),
                    ),
                ),
                1,
            )

        drawn = F.aggregate("qs", start, step, lambda acc: acc["out"])
        both = lambda d: F.array(
            side("lo", "mid", d[SOURCE], d["left"]), side("mid", "hi", d[SOURCE], d["quota"] - d["left"])
        )
        sides = gathered.select(F.explode(F.flatten(F.transform(drawn, both))).alias("side")).select("side.*")
        # One row per node and source; written, so that no level is drawn again for the next.
        nodes = stored(nodes.where(leaf).unionByName(sides), "tree-level")
    return nodes.select(F.col("lo").alias("shard"), SOURCE, F.col("quota").alias("count"))


# Steps of the affine permutation: primes, of which one at least does not divide a quota below their product.
STEPS = (1_000_003, 1_000_033, 1_000_037)


def block_takes(sources: DataFrame, blocks: DataFrame, shard_words: int, seed: str) -> DataFrame:
    """Source, block, and its takes: an array of (pass, shard), the extra pass last if there is one."""
    info = blocks.join(sources.select(SOURCE, "passes", "bits", "last_place"), SOURCE)
    first_place = F.col(BLOCK) * power(F.lit(BITS) - F.col("bits"))
    info = info.withColumn("extra", (first_place <= F.col("last_place")).cast("long"))
    quotas = info.groupBy(SOURCE).agg(F.sum(F.col("passes") + F.col("extra")).alias("quota"), F.count("*").alias("n"))
    words = info.agg(F.sum(F.col("words") * (F.col("passes") + F.col("extra")))).first()[0] or 0
    shards = max(1, math.ceil(words / shard_words))
    leaves = split_quotas(quotas.select(SOURCE, "quota"), shards, seed)
    runs = leaves.groupBy(SOURCE).agg(F.array_sort(F.collect_list(F.struct("shard", "count"))).alias("runs"))
    ends = F.aggregate(
        "runs",
        F.array().cast("array<bigint>"),
        lambda acc, r: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + r["count"])),
    )
    dealt = runs.select(SOURCE, ends.alias("ends")).join(quotas, SOURCE)
    step = reduce(
        lambda other, p: F.when(F.col("quota") % p != 0, F.lit(p)).otherwise(other), reversed(STEPS), F.lit(1)
    )
    draws = info.join(dealt, SOURCE).withColumn("step", step)
    number = lambda p: p * F.col("n") + F.col("number")
    moved = lambda d: F.pmod(F.col("step") * d, F.col("quota"))
    count = F.col("passes") + F.col("extra")
    takes = F.when(
        count > 0,
        F.transform(
            F.sequence(F.lit(0).cast("long"), count - 1),
            lambda p: F.struct(
                p.alias("pass"),
                F.size(F.filter("ends", lambda e: e <= moved(number(p)))).alias("shard"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<pass:bigint,shard:int>>"))
    return stored(draws.select(SOURCE, BLOCK, takes.alias("takes")), "block-takes")


def plan(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: str = "mix",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Narrow rows (id and keys), sources with targets and cuts, and the takes of each block."""
    keyed = with_keys(df, id, text, source, seed).select(F.col(id), SOURCE, SIZE, PLACE)
    keyed = stored(keyed, "mix-keys")
    sources, blocks = plan_sources(keyed, source_targets(keyed, weights, total_share, most), block_words)
    return keyed, sources, block_takes(sources, blocks, shard_words, seed)


def with_takes(keyed: DataFrame, sources: DataFrame, takes: DataFrame) -> DataFrame:
    """Add the source's figures and the row's own takes to rows that have the keys."""
    placed = keyed.join(sources, SOURCE).withColumn(BLOCK, block_of())
    own = F.filter(
        "takes", lambda t: (t["pass"] < F.col("passes")) | (F.col(PLACE) <= F.col("last_place"))
    )
    return placed.join(takes, [SOURCE, BLOCK], "left").withColumn("takes", own)


def decide(df: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """One row per row: id, size, source_size, target, taken, shards (of each take, in order)."""
    return with_takes(*plan(df, id=id, **options)).select(
        F.col(id),
        F.col(SIZE).alias("size"),
        "source_size",
        "target",
        (F.col(SIZE) * F.size("takes")).cast("long").alias("taken"),
        F.transform("takes", lambda t: t["shard"]).alias("shards"),
    )


def mix(
    df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix", **options
) -> DataFrame:
    """The mixed rows with the columns of ``df``: each as often as it is taken, shard by shard, shuffled within."""
    _, sources, takes = plan(df, id=id, text=text, source=source, seed=seed, **options)
    # The row travels as one struct, so that its columns can't clash with those of the plan.
    packed = df.select(F.struct(*df.columns).alias(ROW))
    keyed = with_keys(packed, f"{ROW}.{id}", f"{ROW}.{text}", f"{ROW}.{source}", seed)
    taken = with_takes(keyed, sources, takes).select(ROW, PLACE, F.explode("takes").alias("take"))
    order = sixty_bits(seed, F.col("take.shard").cast("string"), F.col("take.pass").cast("string"), F.col(PLACE).cast("string"))
    return (
        taken.select(ROW, F.col("take.shard").alias("shard"), order.alias("order"))
        .repartition("shard")
        .sortWithinPartitions("shard", "order")
        .select(f"{ROW}.*")
    )
