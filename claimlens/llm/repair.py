"""Cheapest repair of conversations whose turns are missing, blank, repeated, cut off or out of order.

A repaired conversation is empty, or an optional system turn and then user and assistant turns in alternation, ending with the
assistant: ``(s?(ua)+)?`` in role initials. Rows may be kept (0), get the role user or assistant (2) or be deleted (3; blank and duplicate rows
must be), empty turns may be inserted anywhere (2), and a row that breaks off costs 1 if it stays. Of all cheapest ways the one whose edits, as
letters D, I, K and R in order, come first is taken.

Three streams, none of which holds a conversation:

* narrow rows (role initial, fault, digest) are dealt by conversation and sorted by turn. ``mapInPandas`` carries four states' costs and the
  order of their edit strings over Arrow batches; both together are a small automaton, so that a row's backpointer is the
  two-byte number of a transition. Beyond ``BLOCK`` rows the backpointers of a conversation go to a file that lasts as long as the task.
  Traced back block by block they give the edits, in numbered blocks;
* edits and whole rows, dealt and sorted the same way, meet: the rows of a conversation stream past its edits;
* whoever needs the repaired conversations in order reads them as that stream leaves them (``digests``).

Whether a row repeats an earlier one is found by an aggregate over (conversation, digest) that is joined back where a digest occurs
twice, not by a set in memory.

Defined results: turns ascend, null first; rows of one turn are ordered by role, then by the digest of role and text. A null role or
text counts as one space. Rows with null conversation are one conversation. A conversation without rows is absent. Only the four named
columns are read, so other columns may have any name. An empty table gives empty results.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import product
from tempfile import SpooledTemporaryFile, TemporaryFile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.base import stored

# Rows whose backpointers are kept in memory and traced back at once.
BLOCK = 1 << 20

# Bytes of a conversation's edits kept in memory while its rows pass; characters of a batch handed back.
HELD_BYTES, BATCH_CHARS = 1 << 23, 1 << 21

SOUND, BLANK, TRUNCATED = 0, 1, 2
EDITED = "key string, block long, audit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
REPAIRED = "key string, position long, turn string, role string, text string, edit string"

# What stands last in the repaired conversation: nothing, the system, a user, an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = [USER, USER, ASSISTANT, USER]  # the role that may be inserted or given
KEEPS = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEEP_COST, INSERT_COST, REROLE_COST, DELETE_COST, TRUNCATED_COST = 0, 2, 2, 3, 1
MOST_INSERTS = 2  # three would come back to a state that two inserts less reach

# From any state, whatever follows any other one can be had for this much more (from "user": an insert, and a system
# turn deleted instead of kept). What is further behind the cheapest state is on no cheapest way; so the states are finitely many.
FURTHEST = INSERT_COST + DELETE_COST

State = tuple[tuple[int, int] | None, ...]  # per last turn: cost above the least, place among the edit strings
START: State = ((0, 0), None, None, None)


class Automaton:
    """Transitions of the dynamic programme, each found once: costs and string order go along as one state."""

    def __init__(self) -> None:
        self.known: dict[tuple[State, str, bool, bool], tuple[int, State, int]] = {}
        self.moves: list[tuple[tuple[int, str] | None, ...]] = []

    def step(self, state: State, initial: str, must_go: bool, truncated: bool) -> tuple[int, State, int]:
        """Number of the transition, next state, what the least cost grows by."""
        given = state, initial if initial in "sua" else "", must_go, truncated
        if given not in self.known:
            self.known[given] = self.find(*given)
        return self.known[given]

    def find(self, state: State, initial: str, must_go: bool, truncated: bool) -> tuple[int, State, int]:
        ways: dict[int, tuple[int, int, str, int]] = {}
        for source, inserts in product(range(4), range(MOST_INSERTS + 1)):
            if state[source] is None:
                continue
            (cost, place), last = state[source], source
            for _ in range(inserts):
                cost, last = cost + INSERT_COST, FOLLOWS[last]
            stays = TRUNCATED_COST if truncated else 0
            options = [(last, cost + DELETE_COST, "D")]
            if not must_go:
                options.append((FOLLOWS[last], cost + REROLE_COST + stays, "R"))
                if initial and (last, initial) in KEEPS:
                    options.append((KEEPS[last, initial], cost + KEEP_COST + stays, "K"))
            for target, price, letter in options:
                way = price, place, "I" * inserts + letter, source
                ways[target] = min(ways.get(target, way), way)
        least = min(w[0] for w in ways.values())
        ways = {t: w for t, w in ways.items() if w[0] <= least + FURTHEST}
        # All strings end with the letter of this row, so none begins another one: earlier places decide.
        order = sorted(ways, key=lambda t: ways[t][1:3])
        self.moves.append(tuple((ways[t][3], ways[t][2]) if t in ways else None for t in range(4)))
        following = tuple((ways[t][0] - least, order.index(t)) if t in ways else None for t in range(4))
        return len(self.moves) - 1, following, least

    @staticmethod
    def end(state: State) -> tuple[int, str, int]:
        """Cost, closing inserts and last turn of the cheapest complete conversation."""
        ways = []
        for source, inserts in product(range(4), range(MOST_INSERTS + 1)):
            last = source
            for _ in range(inserts):
                last = FOLLOWS[last]
            if state[source] is not None and last in (NOTHING, ASSISTANT):
                cost, place = state[source]
                ways.append((cost + inserts * INSERT_COST, place, "I" * inserts, source))
        cost, _, closing, source = min(ways)
        return cost, closing, source


class Conversation:
    """One conversation's facts, state and backpointers, while its rows stream by."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.state, self.cost, self.rows = automaton, START, 0, 0
        self.pointers, self.file = array("H"), None
        self.faults, self.illegal, self.turns = [0, 0, 0], 0, 0
        self.first = self.turn = self.initial = self.digest = None

    def add(self, turn: int | None, initial: str, fault: int, repeats: bool, digest: str) -> None:
        duplicate = fault != BLANK and (repeats or digest == self.digest)
        truncated = fault == TRUNCATED and not duplicate
        self.faults[0] += fault == BLANK
        self.faults[1] += duplicate
        self.faults[2] += truncated
        self.illegal += self.rows > 0 and self.initial + initial not in ("su", "ua", "au")
        if turn is not None:
            self.turns += turn != self.turn
            self.first, self.turn = turn if self.first is None else self.first, turn
        self.initial, self.digest = initial, digest
        number, self.state, grown = self.automaton.step(self.state, initial, fault == BLANK or duplicate, truncated)
        self.cost += grown
        if len(self.pointers) == BLOCK:
            self.file = self.file or TemporaryFile()
            self.file.write(self.pointers.tobytes())
            self.pointers = array("H")
        self.pointers.append(number)
        self.rows += 1

    def blocks(self) -> Iterator[tuple[int, str]]:
        """Edits in numbered blocks, last block first."""
        cost, closing, at = self.automaton.end(self.state)
        self.cost += cost
        moves, number = self.automaton.moves, (self.rows - 1) // BLOCK
        for block in range(number, -1, -1):
            if block < number:
                self.file.seek(block * BLOCK * 2)
                self.pointers = array("H", self.file.read(BLOCK * 2))
            edits = [closing]
            for pointer in reversed(self.pointers):
                at, edit = moves[pointer][at]
                edits.append(edit)
            closing = ""
            yield block, "".join(reversed(edits))
        if self.file:
            self.file.close()

    def facts(self) -> list[int]:
        gaps = 0 if self.first is None else self.turn - self.first + 1 - self.turns
        return [min(gaps, (1 << 63) - 1), *self.faults, self.illegal, self.cost]


def edits_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of edits; the facts of a conversation stand in its block 0."""
    automaton, key, now, out, chars = Automaton(), None, None, [], 0
    names = ["key", "block", "audit", *FACTS]

    def closed() -> Iterator[tuple]:
        for block, edits in now.blocks():
            yield (key, block, edits, *(now.facts() if block == 0 else [0] * len(FACTS)))

    for frame in frames:
        columns = ("key", "has_turn", "turn", "initial", "fault", "repeats", "digest")
        for row_key, has, turn, initial, fault, repeats, digest in zip(*(frame[c].tolist() for c in columns)):
            if row_key != key:
                for row in closed() if now else ():
                    out.append(row)
                    chars += len(row[2])
                    if chars > BATCH_CHARS:
                        yield pd.DataFrame(out, columns=names)
                        out, chars = [], 0
                key, now = row_key, Conversation(automaton)
            now.add(turn if has else None, initial, fault, repeats, digest)
        if out:
            yield pd.DataFrame(out, columns=names)
            out, chars = [], 0
    for row in closed() if now else ():
        yield pd.DataFrame([row], columns=names)


def repaired_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of the repaired conversations: first the blocks of a conversation's edits come by, then its rows."""
    key, edits, last, position, out, chars = None, None, NOTHING, 0, [], 0
    names = ["key", "position", "turn", "role", "text", "edit"]

    def inserted() -> tuple:
        nonlocal last, position
        last, position = FOLLOWS[last], position + 1
        return key, position - 1, None, ROLE[last], "", "I"

    def closing() -> Iterator[tuple]:
        while edits is not None and edits.read(1):
            yield inserted()

    for frame in frames:
        columns = ("key", "kind", "audit", "turn", "role", "text")
        for row_key, kind, audit, turn, role, text in zip(*(frame[c].tolist() for c in columns)):
            if row_key != key:
                out.extend(closing())
                key, edits, last, position = row_key, SpooledTemporaryFile(HELD_BYTES), NOTHING, 0
                reading = False
            if kind == 0:
                edits.write(audit.encode())
                continue
            if not reading:
                edits.seek(0)
                reading = True
            while (edit := edits.read(1)) == b"I":
                out.append(inserted())
            if edit != b"D":
                last = KEEPS[last, role[0]] if edit == b"K" else FOLLOWS[last]
                out.append((key, position, turn, role if edit == b"K" else ROLE[last], text, edit.decode()))
                position += 1
                chars += len(text)
            if chars > BATCH_CHARS:
                yield pd.DataFrame(out, columns=names)
                out, chars = [], 0
        if out:
            yield pd.DataFrame(out, columns=names)
            out, chars = [], 0
    out.extend(closing())
    if out:
        yield pd.DataFrame(out, columns=names)


def digests_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key, digest = None, None
    for frame in frames:
        out = []
        for row_key, role, text in zip(frame["key"].tolist(), frame["role"].tolist(), frame["text"].tolist()):
            if row_key != key:
                if digest:
                    out.append((key, digest.hexdigest()))
                key, digest = row_key, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield pd.DataFrame(out, columns=["key", "repaired_sha256"])
    if digest:
        yield pd.DataFrame([(key, digest.hexdigest())], columns=["key", "repaired_sha256"])


def key_of(conversation: Column) -> Column:
    """A conversation's id as text that is never null."""
    return F.when(conversation.isNull(), "null").otherwise(F.concat(F.lit("="), conversation.cast("string")))


def narrow_rows(rows: DataFrame) -> DataFrame:
    """Per row: key, turn, role, digest, initial, fault, and whether an earlier turn has the same role and text."""
    sign = r"[^\x20\x09-\x0D]"
    fault = (
        F.when(~F.col("text").rlike(sign), BLANK)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED)
        .otherwise(SOUND)
    )
    narrow = rows.select("key", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")  # null first
    first = narrow.groupBy("key", "digest").agg(F.min(turn).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return narrow.join(first, ["key", "digest"], "left").withColumn("repeats", F.coalesce(turn > F.col("first"), F.lit(False)))


def repair(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(blocks of edits with the facts of each conversation, rows of the repaired conversations).

    The rows of one repaired conversation lie in one partition, in order of their position.
    """
    space = F.lit(" ")
    rows = df.select(
        key_of(F.col(conversation)).alias("key"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), space).alias("role"),
        F.coalesce(F.col(text).cast("string"), space).alias("text"),
    ).withColumn("digest", F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    order = [F.asc_nulls_first("turn"), "role", "digest"]
    narrow = narrow_rows(rows).repartition("key").sortWithinPartitions("key", *order)
    streamed = narrow.select(
        "key", F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn"), "initial", "fault", "repeats", "digest"
    )
    edits = stored(streamed.mapInPandas(edits_of, EDITED), "edits")
    both = edits.select("key", F.lit(0).alias("kind"), "block", "audit").unionByName(
        rows.withColumns({"kind": F.lit(1), "block": F.lit(0).cast("long")}), allowMissingColumns=True
    )
    dealt = both.repartition("key").sortWithinPartitions("key", "kind", "block", *order)
    passing = dealt.select("key", "kind", "audit", F.col("turn").cast("string").alias("turn"), "role", "text")
    return edits, passing.mapInPandas(repaired_rows, REPAIRED)


def facts(edits: DataFrame) -> DataFrame:
    """key, facts and the whole edit string of each conversation."""
    blocks = F.sort_array(F.collect_list(F.struct("block", "audit")))
    whole = F.array_join(F.transform(blocks, lambda b: b["audit"]), "")
    return edits.groupBy("key").agg(*(F.max(c).alias(c) for c in FACTS), whole.alias("audit"))


def digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation's ``role:text`` lines, read in the order in which ``repair`` leaves them."""
    return repaired.mapInPandas(digests_of, "key string, repaired_sha256 string")


def report(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: id, facts, edit string, digest of the repaired conversation (none if it is empty)."""
    edits, repaired = repair(df, conversation, turn, role, text)
    found = facts(edits).join(digests(repaired), "key", "left")
    id = F.when(F.col("key") != "null", F.expr("substring(key, 2)")).cast(df.schema[conversation].dataType)
    return found.select(id.alias(conversation), *FACTS, "audit", "repaired_sha256")
