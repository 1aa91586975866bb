"""Chat formatting in budgeted windows.

A conversation is cut into windows at turn boundaries. Prefix sums of the turns' token counts choose
the spans: a turn belongs to the span in which its first token falls, spans being ``fresh`` tokens wide.
Each window opens with the system turn, if the conversation has one, then repeats the latest turns of
the span before (as many whole turns as fit ``history`` tokens), then has the turns of its own span.
Only assistant turns of the window's own span are under the loss mask, so each is learnt from once.
A turn is never cut: a span may overrun its width by its last turn.

The template is ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n`` per turn. Control strings of common templates
inside a text get a backslash after their first character (one more, where backslashes stand there
already), which ``unescape`` takes away again. Roles are URL-encoded.

Defined results: a null text is empty; a null role is an empty role, never under the loss mask. Turns
are ordered by turn number (null first), then role, then text, so repeated rows and ties keep one fixed
order. Rows with a null conversation id are one conversation. Only a first turn can be the system
turn. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens.llm.base import text_of

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"

# What opens a turn or a control token in common templates, after its first character.
CONTROL = r"\|[A-Za-z0-9_]+\|>|/?s>|/?INST\]|<SYS>>|</SYS>>"

FRESH, HISTORY = 768, 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({CONTROL})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({CONTROL})", "$1$2$3")


def token_estimate(text: Column) -> Column:
    """Tokens of a turn by rule of thumb, marks included: a token for every four bytes, and eight."""
    return F.ceil(F.octet_length(text) / F.lit(4)) + F.lit(8)


def windows(
    df: DataFrame,
    fresh: int = FRESH,
    history: int = HISTORY,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tokens: Column | None = None,
) -> DataFrame:
    """One row per window: conv_id, window (from 0), formatted, n_repeated, losses.

    ``n_repeated`` counts the turns at the top that earlier windows have shown already. ``losses`` lists start (from
    0) and length, in characters of ``formatted``, of the texts under the loss mask, in order.
    ``tokens`` may give the token count of a turn; it must be positive.
    """
    if history > fresh:
        raise ValueError("history must not be wider than a span")
    content = text_of(text)
    turns = df.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        text_of(role).alias("role"),
        content.alias("text"),
        (token_estimate(content) if tokens is None else tokens).cast("long").alias("tokens"),
    )
    ahead = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = turns.withColumn("n", F.row_number().over(ahead)).withColumn(
        "system", (F.col("n") == 1) & (F.col("role") == "system")
    )
    # The system turn is outside the budget of the spans.
    counted = F.when(F.col("system"), F.lit(0)).otherwise(F.col("tokens"))
    by_n = W.partitionBy("conv_id").orderBy("n")
    turns = turns.withColumn("start", F.sum(counted).over(by_n.rowsBetween(W.unboundedPreceding, 0)) - counted)
    turns = turns.withColumn("span", F.floor(F.col("start") / F.lit(fresh)))
    turns = turns.withColumn("opens", F.coalesce(F.col("span") != F.lag("span").over(by_n), F.lit(True)))
    numbered = F.sum(F.col("opens").cast("long")).over(by_n.rowsBetween(W.unboundedPreceding, 0)) - 1
    turns = turns.withColumn("window", numbered)
    # The start of the window after this turn's: read from the end, the last start seen of another window.
    from_end = W.partitionBy("conv_id").orderBy(F.desc("n"))
    behind = from_end.rowsBetween(W.unboundedPreceding, -1)
    next_start = F.last(F.when(F.col("opens"), F.col("start")), ignorenulls=True).over(behind)
    turns = turns.withColumn("next_start", next_start)
    last_window = F.max("window").over(W.partitionBy("conv_id"))
    turns = turns.withColumn("last_window", last_window)

    # Where a turn is shown: in its own window; as history in the next; the system turn in all.
    own = F.array(F.struct(F.col("window").alias("window"), F.lit(False).alias("repeated")))
    later = F.transform(
        F.when(
            F.col("system") & (F.col("last_window") > 0), F.sequence(F.lit(1).cast("long"), F.col("last_window"))
        )
        .when(~F.col("system") & (F.col("next_start") - F.col("start") <= history), F.array(F.col("window") + 1))
        .otherwise(F.array().cast("array<bigint>")),
        lambda w: F.struct(w.alias("window"), F.lit(True).alias("repeated")),
    )
    shown = turns.withColumn("at", F.explode(F.concat(own, later))).select(
        "conv_id", F.col("at.window").alias("window"), F.col("at.repeated").alias("repeated"), "n", "role", "text"
    )
    head = F.concat(F.lit(OPEN), F.url_encode(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    marked = shown.select(
        "conv_id",
        "window",
        F.struct(
            "n",
            "repeated",
            F.concat(head, body, F.lit(CLOSE)).alias("piece"),
            F.char_length(head).alias("lead"),
            F.char_length(body).alias("length"),
            (~F.col("repeated") & (F.col("role") == "assistant")).alias("learnt"),
        ).alias("t"),
    )
    gathered = marked.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    spans = F.aggregate(
        "ts",
        F.struct(
            F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("losses")
        ),
        lambda acc, t: F.struct(
            (acc["at"] + F.char_length(t["piece"])).alias("at"),
            F.when(
                t["learnt"],
                F.concat(
                    acc["losses"],
                    F.array(F.struct((acc["at"] + t["lead"]).alias("start"), t["length"].alias("length"))),
                ),
            )
            .otherwise(acc["losses"])
            .alias("losses"),
        ),
    )
    return gathered.select(
        "conv_id",
        "window",
        F.array_join(F.transform("ts", lambda t: t["piece"]), "").alias("formatted"),
        F.size(F.filter("ts", lambda t: t["repeated"])).alias("n_repeated"),
        spans["losses"].alias("losses"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Conversations from windows: conv_id, turns (array of role, text), losses (array of text), formatted_chars."""
    cut = F.split(F.col("formatted"), r"<\|im_end\|>\n", -1)
    shown = F.slice(cut, F.lit(1), F.size(cut) - 1)
    fresh = F.slice(shown, F.col("n_repeated") + 1, F.size(shown))
    name = lambda x: F.substring_index(x, "\n", 1)
    turn = lambda x: F.struct(
        F.url_decode(F.substr(name(x), F.lit(len(OPEN) + 1))).alias("role"),
        unescape(F.substr(x, F.char_length(name(x)) + 2)).alias("text"),
    )
    parsed = formatted.select(
        "conv_id",
        F.struct(
            "window",
            F.transform(fresh, turn).alias("turns"),
            F.transform(
                "losses", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))
            ).alias("losses"),
        ).alias("w"),
        F.char_length("formatted").cast("long").alias("chars"),
    )
    gathered = parsed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("w")).alias("ws"), F.sum("chars").alias("formatted_chars")
    )
    return gathered.select(
        "conv_id",
        F.flatten(F.transform("ws", lambda w: w["turns"])).alias("turns"),
        F.flatten(F.transform("ws", lambda w: w["losses"])).alias("losses"),
        "formatted_chars",
    )
