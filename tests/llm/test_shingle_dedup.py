import random
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F
from test_simhash_dedup import slow_fingerprint

import corpus_pipeline
from millrace.llm import shingle_dedup as m


def slow_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near(a, b):
    return a == b or (a | b and Fraction(len(a & b), len(a | b)) >= Fraction(4, 5))


def slow_kept(docs):
    """Ids that stay: least of each group of linked texts."""
    sets, group = [slow_set(t) for _, t in docs], list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if group[i] != group[j] and near(sets[i], sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return sorted({g: min(k for (k, _), h in zip(docs, group) if h == g) for g in group}.values())


def edited_corpus(seed=0):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(2000)]
    docs = [" ".join(r.choices(words, k=r.randint(60, 300))) for _ in range(60)]
    for text in docs[:60]:
        for edits in (1, 3, 6):
            copy = text.split()
            for _ in range(edits):
                copy[r.randrange(len(copy))] = r.choice(words)
            docs.append(" ".join(copy))
    large = docs[0].split()
    docs += [" ".join(large[:-1] + [f"end{i}"]) for i in range(40)] + ["a b", "A  b", "a b c d e", "", " ", None]
    return list(enumerate(docs))


def test_edited_copies_equal_brute_force(spark):
    docs = edited_corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = m.keep_one(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == slow_kept(docs)


def test_stage_drops_an_edited_copy_beyond_four_bits(spark):
    docs = edited_corpus()
    apart = lambda a, b: (slow_fingerprint(a) ^ slow_fingerprint(b)).bit_count()
    pairs = [(i, j) for i in range(60) for j in range(60 + 3 * i, 63 + 3 * i) if near(slow_set(docs[i][1]), slow_set(docs[j][1])) and apart(docs[i][1], docs[j][1]) > 4]
    assert len(pairs) > 10
    chosen = {i: j for i, j in pairs}
    df = spark.createDataFrame([(*docs[k], "en", "s", 1) for x in chosen.items() for k in x], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.remove_near_copies(spark, df, "").collect()) == sorted(chosen)


def test_fingerprints_bring_near_copies_together(spark):
    """A long text with one word changed has a fingerprint near the first one's; the trie join finds it without any band."""
    words = [f"w{i}" for i in range(600)]
    texts = [" ".join(words), " ".join([*words[:300], "other", *words[301:]]), " ".join(f"v{i}" for i in range(600))]
    sets = [m.shingle_set(t.encode()) for t in texts]
    rows = [(i, len(s), int(np.uint64(m.simprint(s)).view(np.int64))) for i, s in enumerate(sets)]
    nodes = spark.createDataFrame(rows, "fp long, n int, print long")
    assert bin(m.simprint(sets[0]) ^ m.simprint(sets[1])).count("1") <= 4
    assert [tuple(r) for r in m.print_candidates(nodes).collect()] == [(0, 1)]
    assert m.print_candidates(nodes.limit(0)).isEmpty()


def test_the_stage_asks_the_trie_join(spark, monkeypatch):
    asked = []
    real = m.near_links
    monkeypatch.setattr(m, "near_links", lambda distinct: asked.append(distinct) or real(distinct))
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "x y")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in m.keep_one(docs).collect()) == [1, 3]
    assert len(asked) == 1


def template_family(n, shared=100):
    """Texts of one template in pairs: only partners are near copies."""
    r = random.Random(5)
    body = [f"b{i}" for i in range(shared)]
    docs = []
    for k in range(n):
        own = [f"o{k}_{i}" for i in range(28)]
        docs += [" ".join(body + own + ["end"]), " ".join(body + own + [f"other{k}"])]
    r.shuffle(docs)
    return list(enumerate(docs))


def test_template_families_lose_no_pair(spark):
    """All texts share most of their bands at 0.6; only partners reach 0.8. Neighbours in a bucket's order alone miss partners."""
    docs = template_family(40)
    sets = [slow_set(t) for _, t in docs]
    assert sum(near(a, b) for i, a in enumerate(sets) for b in sets[:i]) == 40
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in m.keep_one(df).collect()) == slow_kept(docs)


def test_all_pairs_of_a_trie_group_are_decided(spark, monkeypatch):
    """Three fingerprints in one group; the first is like neither of the others, which are near copies. No band helps."""
    monkeypatch.setattr(m, "candidates", lambda nodes, bands: bands.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0))
    monkeypatch.setattr(m, "simprint", lambda hashes: 7)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), " ".join(f"v{i}" for i in range(200)), "a b c d e f"]
    order = sorted(texts, key=lambda t: int(np.uint64(m._node(m.shingle_set(t.encode()))).view(np.int64)))
    partners = [i for i, t in enumerate(texts) if t.startswith("w0")]
    assert len(partners) == 2
    docs = list(enumerate(texts))
    for extra in range(200):
        if not order[0].startswith("w0"):
            break
        docs[2] = (2, " ".join(f"v{extra}_{i}" for i in range(200)))
        order = sorted([t for _, t in docs], key=lambda t: int(np.uint64(m._node(m.shingle_set(t.encode()))).view(np.int64)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in m.keep_one(df).collect()) == slow_kept(docs) == [0, 2, 3]


def test_blocks_decide_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 300)
    docs = template_family(12) + [(100 + i, t) for i, t in template_family(6, shared=60)] + [(200, "z " * 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in m.keep_one(df).collect()) == slow_kept(docs)
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 12, 10).astype(np.uint64)) for _ in range(30)]
    for cut in (30, 13):
        roots = np.arange(30)
        got = m.linked(sets, roots, cut)
        want = [(i, j) for i in range(cut) for j in range(cut if cut < 30 else i + 1, 30) if near(set(sets[i].tolist()), set(sets[j].tolist()))]
        assert set(got) <= set(want)
        group = lambda links: [min(reach(k, links)) for k in range(30)]
        assert group(got) == group(want)


def reach(k, links):
    seen, todo = {k}, [k]
    while todo:
        x = todo.pop()
        for a, b in links:
            for y, z in ((a, b), (b, a)):
                if y == x and z not in seen:
                    seen.add(z)
                    todo.append(z)
    return seen
