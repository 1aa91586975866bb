"""Conversation repair: an exhaustive search for short conversations, costs-to-go and greedy choice for longer ones."""

import hashlib
import random
import re
import zlib
from itertools import product

import pyarrow.parquet as pq

from claimlens.llm import queries, repair
from claimlens.llm.base import table

SIGN = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id long, turn long, role string, text string"
FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def faults_of(rows):
    found, seen = [], set()
    for role, text in rows:
        signs = SIGN.findall(text)
        kind = "blank" if not signs else "duplicate" if (role, text) in seen else "" if signs[-1] in ".!?" else "truncated"
        seen.add((role, text))
        found.append(kind)
    return found


def exhaustive(rows):
    """Least (cost, edits) and the repaired turns, over all ways with up to two inserts at each place."""
    faults, best = faults_of(rows), None
    inserts = [p for n in range(3) for p in product("ua", repeat=n)]
    for gaps in product(inserts, repeat=len(rows) + 1):
        for ops in product(("D", "K", "Ru", "Ra"), repeat=len(rows)):
            if any(f in ("blank", "duplicate") and o != "D" for f, o in zip(faults, ops)):
                continue
            cost, edits, out = 0, "", []
            for i, gap in enumerate(gaps):
                cost, edits, out = cost + 2 * len(gap), edits + "I" * len(gap), out + [(NAMES[g], "") for g in gap]
                if i < len(rows):
                    op, (role, text) = ops[i], rows[i]
                    edits += op[0]
                    cost += {"D": 3, "K": 0, "R": 2}[op[0]] + (op != "D" and faults[i] == "truncated")
                    out += [] if op == "D" else [(role if op == "K" else NAMES[op[1]], text)]
            if re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in out)) and (best is None or (cost, edits) < best[:2]):
                best = cost, edits, out
    return best


NAMES = {"u": "user", "a": "assistant"}
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
FITS = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def greedy(rows):
    """Costs-to-go from the end, then the first letter that stays on a cheapest way."""
    faults, n = faults_of(rows), len(rows)
    go = [{} for _ in range(n + 1)]

    def ways(i, last):
        if i < n:
            stay = faults[i] == "truncated"
            yield "D", 3, i + 1, last
        yield "I", 2, i, NEXT[last]
        if i < n and faults[i] not in ("blank", "duplicate"):
            if (last, rows[i][0][:1]) in FITS:
                yield "K", stay, i + 1, rows[i][0][:1]
            yield "R", 2 + stay, i + 1, NEXT[last]

    for i in range(n, -1, -1):
        go[i] = {s: 0 if i == n and s in ("", "a") else 10**9 for s in NEXT}
        for _ in range(4):  # inserts stay at this row
            for s in NEXT:
                go[i][s] = min([go[i][s]] + [c + go[j][t] for _, c, j, t in ways(i, s)])
    i, last, edits, out = 0, "", "", []
    while not (i == n and go[i][last] == 0):
        letter, _, j, t = next(w for w in ways(i, last) if w[1] + go[w[2]][w[3]] == go[i][last])
        edits += letter
        if letter == "I":
            out.append((NAMES[t], ""))
        elif letter != "D":
            out.append((rows[i][0] if letter == "K" else NAMES[t], rows[i][1]))
        i, last = j, t
    return go[0][""], edits, out


def expected(rows, search=greedy):
    """Facts, edits and digest of (turn, role, text) rows."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=sort_key)
    said = [(r, x) for _, r, x in rows]
    turns = [t for t, _, _ in rows if t is not None]
    kinds = faults_of(said)
    cost, edits, out = search(said)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(said, said[1:])]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
    text = "\n".join(f"{r}:{x}" for r, x in out)
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost), edits, hashlib.sha256(text.encode()).hexdigest()


def sort_key(row):
    turn, role, text = row
    return turn is not None, turn or 0, role.encode(), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def compare(spark, conversations):
    rows = [(c, *r) for c, given in conversations.items() for r in given]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {r.conv_id: r for r in repair.report(df).collect()}
    assert set(found) == {c for c, given in conversations.items() if given}
    nothing = hashlib.sha256().hexdigest()
    for c, given in conversations.items():
        if given:
            r = found[c]
            assert (tuple(r[f] for f in FACTS), r.audit, r.repaired_sha256 or nothing) == expected(given), (c, given)


def drawn(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "User", "", None, "a", "s"]
    texts = ["Yes.", "No!", "cut off", "", " \n", None, "Why? ", "é。", "ok.\t", "Yes."]
    turns = [rng.choice([None, *range(n)]) if rng.random() < 0.1 else i for i in range(n)]
    return [(t, rng.choice(roles), rng.choice(texts) if rng.random() < 0.7 else f"text {rng.random()}.") for t in turns]


def test_against_all_ways(spark):
    rng = random.Random(7)
    given = {i: drawn(rng, rng.choice([1, 2, 3])) for i in range(60)}
    for rows in given.values():
        assert expected(rows, exhaustive) == expected(rows)
    compare(spark, given)


def test_long_null_and_odd(spark):
    rng = random.Random(11)
    given = {i: drawn(rng, rng.randrange(1, 40)) for i in range(150)}
    given[None] = drawn(rng, 30)
    given[-1] = [(None, None, None)] * 5
    given[-2] = [(3, "user", "Hi there.")] * 4 + [(9, "assistant", "x" * 3_000_000 + ".")]
    given[-3] = [(-(2**62), "system", "Be brief."), (2**61, "user", "?")]
    compare(spark, given)


def test_blocks_of_a_hot_conversation(spark, monkeypatch):
    """A conversation of many blocks; backpointers and edits of the others stay apart from it."""
    conversation = repair.Conversation(repair.Automaton())
    monkeypatch.setattr(repair, "BLOCK", 16)
    rng = random.Random(5)
    rows = drawn(rng, 1000)
    rows = sorted(((t, r or " ", " " if x is None else x) for t, r, x in rows), key=sort_key)
    kinds, digests = faults_of([r[1:] for r in rows]), [str(r[1:]) for r in rows]
    for (turn, role, _), kind, digest in zip(rows, kinds, digests):
        fault = {"blank": repair.BLANK, "truncated": repair.TRUNCATED}.get(kind, repair.SOUND)
        conversation.add(turn, role[:1], fault, kind == "duplicate", digest)
    blocks = sorted(conversation.blocks())
    cost, edits, _ = greedy([r[1:] for r in rows])
    assert len(blocks) == 63 and "".join(b for _, b in blocks) == edits and conversation.cost == cost
    compare(spark, {1: [(i, "user" if i % 2 else "assistant", f"{i}.") for i in range(9000)], 2: drawn(rng, 9), 3: drawn(rng, 9)})


def test_empty_and_clashing(spark):
    names = SCHEMA + ", key string, audit string, digest string"
    assert repair.report(spark.createDataFrame([], names)).collect() == []
    rows = [(1, 0, "user", "Hi.", "k", "a", "d"), (1, 1, "assistant", "Yes.", "k", "a", "d")]
    found = repair.report(spark.createDataFrame(rows, names)).collect()[0]
    assert (found.audit, found.cost) == ("KK", 0)


def test_few_transitions():
    """A backpointer has two bytes: all transitions that can be reached are far fewer than 65,536."""
    automaton, known, ahead = repair.Automaton(), {repair.START}, [repair.START]
    while ahead:
        state = ahead.pop()
        for initial, (gone, cut) in product(["s", "u", "a", "x"], [(False, False), (False, True), (True, False)]):
            following = automaton.step(state, initial, gone, cut)[1]
            if following not in known:
                known.add(following)
                ahead.append(following)
    assert len(automaton.moves) < 5000


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    given = table(spark, folder, "conversations").collect()
    conversations = {}
    for row in given:
        rows = conversations.setdefault(row.conv_id, [])
        way = zlib.crc32(f"{row.conv_id}:{row.turn}".encode()) % 20
        text = "" if way == 1 else re.sub("[.!?]", "", row.text) if way == 2 else row.text
        rows += [(row.turn, "user" if way == 4 else row.role, text)] * {0: 0, 3: 2}.get(way, 1)
    found = {r.conv_id: r for r in queries.op12_conversation_repair(spark, folder).collect()}
    assert set(found) == set(conversations)
    for c, rows in conversations.items():
        assert (tuple(found[c][f] for f in FACTS), found[c].audit, found[c].repaired_sha256) == expected(rows)


def test_sql_agrees_on_odd_conversations(spark, tmp_path):
    from oracle import compare, connect

    rng = random.Random(3)
    rows = [(c, *r) for c in (*range(40), None) for r in drawn(rng, rng.randrange(1, 12))]
    pq.write_table(spark.createDataFrame(rows, SCHEMA).toArrow(), tmp_path / "conversations.parquet")
    assert compare(queries.op12_conversation_repair(spark, str(tmp_path)), queries.ORACLES["op12_conversation_repair"], connect(str(tmp_path))) == []


def test_query_keeps_conversations_without_rows(spark, tmp_path):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi."), (None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: r for r in queries.op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(found) == {gone, None} and found[gone].audit == "" and found[gone].cost == 0
    assert found[gone].repaired_sha256 == hashlib.sha256().hexdigest()
