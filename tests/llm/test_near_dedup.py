"""Near dedup against the shingles themselves."""

from collections import defaultdict

import numpy as np

import corpus_pipeline
from claimlens.llm import near_dedup


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def share(a, b):
    return len(a & b) / len(a | b)


def edited(words, fraction, r):
    """A copy of which so many of the shingles are not in the original: words at the end are new."""
    k = round(fraction * len(words))
    return words[: len(words) - k] + [f"e{x}" for x in r.integers(0, 10**9, k)]


def test_near_copies_by_shared_shingles(spark, docs):
    """Pairs on both sides of 0.8: found above it, never dropped below it."""
    r = np.random.default_rng(7)
    rows, pairs = [], []
    for i in range(400):
        words = [f"w{x}" for x in r.integers(0, 10**9, int(r.integers(60, 500)))]
        other = edited(words, r.uniform(0.02, 0.2), r)
        texts = [" ".join(words), " ".join(other)]
        rows += [(2 * i + j, t, "a") for j, t in enumerate(texts)]
        pairs.append(share(*map(shingles, texts)))
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, docs(rows), "").collect()}
    assert all(2 * i in kept for i in range(400))
    below = [i for i, s in enumerate(pairs) if s < 0.8]
    above = [i for i, s in enumerate(pairs) if s >= 0.8]
    assert len(below) > 100 and len(above) > 150
    assert all(2 * i + 1 in kept for i in below)
    missed = [pairs[i] for i in above if 2 * i + 1 in kept]
    assert len(missed) <= 0.02 * len(above)


def test_groups_of_near_copies(spark, docs):
    """Groups above and below SMALL, with a bridge between two halves, repeated rows and null ids."""
    r = np.random.default_rng(8)
    texts = []
    for size in (2, 5, 60):
        words = [f"w{x}" for x in r.integers(0, 10**9, 200)]
        for _ in range(size):
            at = int(r.integers(0, 200))
            texts.append(" ".join(words[:at] + [f"x{r.integers(10**9)}"] + words[at + 1 :]))
        texts.append(" ".join(edited(words, 0.09, r)))  # 0.8 to the copies at the edge only
    rows = [(i, t, "a") for i, t in enumerate(texts)] + [(None, texts[0], "a"), (3, texts[3], "a"), (500, "", "a"), (501, None, "a")]
    sets = [shingles(t or "") for _, t, _ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if share(sets[i], sets[j]) >= 0.8:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, row in enumerate(rows):
        groups[root(i)].append(row[0])
    want = sorted(min(x for x in g if x is not None) for g in groups.values())
    assert sorted(r.doc_id for r in near_dedup.dedup(docs(rows)).collect()) == want
    assert near_dedup.dedup(docs([])).collect() == []


def test_large_groups_next_to_the_threshold(spark, docs):
    """Families of 120 texts in which most candidates are just below 0.8: no link that a bucket holds is left out."""
    r = np.random.default_rng(2)
    rows, wanted = [], 0
    for _ in range(6):
        words = [f"w{x}" for x in r.integers(0, 10**9, 400)]
        sets, parent = [], list(range(120))

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for i in range(120):
            own = list(words)
            for at in r.choice(400, int(r.integers(4, 6, endpoint=True)), replace=False):
                own[at] = f"x{r.integers(10**9)}"
            rows.append((len(rows), " ".join(own), "a"))
            sets.append(shingles(rows[-1][1]))
            for j in range(i):
                if share(sets[i], sets[j]) >= 0.8:
                    parent[root(i)] = root(j)
        wanted += len({root(i) for i in range(120)})
    assert len({r.doc_id for r in near_dedup.dedup(docs(rows)).collect()}) == wanted


def family(n, r):
    """Texts of one family, most pairs just below 0.8."""
    words, texts = [f"w{x}" for x in r.integers(0, 10**9, 400)], []
    for _ in range(n):
        own = list(words)
        for at in r.choice(400, int(r.integers(5, 6, endpoint=True)), replace=False):
            own[at] = f"x{r.integers(10**9)}"
        texts.append(" ".join(own))
    return texts


def test_false_candidates_of_a_family_stay_in_their_task(spark, docs, monkeypatch):
    """However many pairs are false, no step hands on more rows than a member has buckets; cut buckets give the same rows."""
    r, seen, stored = np.random.default_rng(5), [], near_dedup.stored

    def counted(df, name):
        table = stored(df, name)
        seen.append((name, table.count()))
        return table

    def kept(texts):
        seen.clear()
        return sorted(x.doc_id for x in near_dedup.dedup(docs([(i, t, "a") for i, t in enumerate(texts)])).collect())

    monkeypatch.setattr(near_dedup, "stored", counted)
    texts = family(400, r)
    want = kept(texts)
    assert any(n for name, n in seen if name == "near-open")
    assert max(n for _, n in seen) <= near_dedup.PRINTS * near_dedup.BANDS * len(texts)
    monkeypatch.setattr(near_dedup, "SHINGLES", 20_000)
    assert kept(texts) == want
