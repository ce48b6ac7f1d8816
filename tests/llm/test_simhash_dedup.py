import random

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash_dedup as m


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints):
    """prints: list of (id, fp) -> list of (id, least id reachable)."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(prints):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return [(k, least.get(find(i))) for i, (k, _) in enumerate(prints)]


def corpus(seed=0):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(r.choices(words, k=r.randint(0, 60)))) for i in range(60)]
    for i in range(60, 160):
        base = docs[r.randrange(60)][1].split()
        for _ in range(r.randint(0, 3)):
            if base:
                base[r.randrange(len(base))] = r.choice(words)
        docs.append((i, " ".join(base)))
    return docs + [(160, None), (161, ""), (162, " \t "), (5, "a b"), (None, "A B"), (None, None), (163, "word " * 30000), (164, "É É é x y")]


def test_fingerprint_and_groups_equal_brute_force(spark, rows):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS fp", "2 AS root", "3 AS _row")
    prints = [(k, slow_fingerprint(t)) for k, t in docs]
    want = sorted(((k, f"{fp:016x}", c) for (k, fp), (_, c) in zip(prints, slow_groups(prints))), key=str)
    assert sorted((tuple(r) for r in m.near_duplicates(df).collect()), key=str) == want
    docs = [d for d in docs if d != (5, "a b")]
    prints = [(k, slow_fingerprint(t)) for k, t in docs]
    kept = m.keep_one(df.filter("text <> 'a b' OR text IS NULL"))
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=str) == sorted({c for _, c in slow_groups(prints)}, key=str)


def test_equal_rows_leave_one(spark):
    df = spark.createDataFrame([(1, "a b c d e")] * 3 + [(None, "q r s t u")] * 2, "doc_id long, text string")
    assert sorted((tuple(r) for r in m.keep_one(df).collect()), key=str) == [(1, "a b c d e"), (None, "q r s t u")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert m.near_duplicates(df).collect() == [] and m.keep_one(df).collect() == []


@pytest.mark.parametrize("hot", [False, True])
def test_links_of_fingerprints(spark, monkeypatch, hot):
    """Random, close and hot fingerprints; with a low limit, frequent block values go by trie node pairs."""
    if hot:
        monkeypatch.setattr(m, "GROUP_ROWS", 8)
    monkeypatch.setattr(m, "FRONTIER", 50)
    r = random.Random(1)
    centres = [r.getrandbits(64) for _ in range(40)]
    values = set(centres)
    for c in centres[:6]:
        for _ in range(40):
            values.add(c ^ sum({1 << r.randrange(64) for _ in range(r.randint(1, 6))}))
    for _ in range(150):
        values.add((centres[0] & ~0xFFF) | r.getrandbits(12))
    values = sorted(values)
    prints = spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)], "doc_id long, fp long")
    got = {x["doc_id"]: x["component_id"] for x in m.grouped(prints).collect()}
    assert got == dict(slow_groups(list(enumerate(values))))


def test_dense_group_is_one_label():
    values = np.sort(np.random.default_rng(0).integers(0, 1 << 14, 6000).astype(np.uint64))
    values = np.unique(values)
    labels = m.trie_join(values, np.array([[0, len(values), 0, len(values)]]), 13, 4)
    assert (labels == 0).all()
