import random

import numpy as np

from millrace.llm import toxicity as m


def rows(seed, n, share=8):
    """One of ``share`` + 1 rows is toxic; a term is in a third of toxic and a sixteenth of other rows."""
    r, out = random.Random(seed), []
    for i in range(n):
        bad = int(i % (share + 1) == 0)
        text = r.choices([f"w{k}" for k in range(60)], k=15)
        if r.random() < (1 / 3 if bad else 1 / 16):
            text.insert(3, "hinter")
        out.append((i, " ".join(text), bad))
    return out


def test_thinning_a_label_changes_no_scores(spark):
    table = spark.createDataFrame(rows(1, 5400), "doc_id long, text string, toxic int")
    docs = spark.createDataFrame([x[:2] for x in rows(2, 400)], "doc_id long, text string")
    whole, thin = (m.score_texts(docs, m.learn(table, max_examples=n)).collect() for n in (10_000, 600))
    assert abs(np.mean([x["score"] for x in whole]) - np.mean([x["score"] for x in thin])) < 0.05
    assert not any(x["predicted"] for x in whole) and not any(x["predicted"] for x in thin)


def test_rare_slur_and_exact_copy(spark):
    table = rows(3, 18_000)
    toxic = [i for i, _, bad in table if bad]
    for i in toxic[:len(toxic) // 200]:
        table[i] = (i, table[i][1] + " skarnfel", 1)
    table[toxic[-1]] = (toxic[-1], "quopp zzim trell", 1)
    index = m.learn(spark.createDataFrame(table, "doc_id long, text string, toxic int"))
    docs = spark.createDataFrame([(1, "you skarnfel"), (2, "Quopp zzim, trell"), (3, "quopp zzim other"), (4, "")], "doc_id long, text string")
    got = {x["doc_id"]: x for x in m.score_texts(docs, index).collect()}
    assert got[1]["predicted"] == 1 and got[2]["predicted"] == 1 and not got[3]["predicted"] and not got[4]["predicted"]
    assert [(x["example"], x["cosine"], x["label"]) for x in got[2]["evidence"]] == [(str(toxic[-1]), 1.0, 1)]


def test_reader_equals_plain_vectors(monkeypatch):
    r = random.Random(4)
    letters = [r.choice(["ab", "ba", "cab"]) * r.randint(1, 4) + r.choice("xyz") for _ in range(300)]
    terms = sorted({t for _ in range(400) for t in m.terms_of(r.choices(letters, k=6))})
    vocabulary = {t: i for i, t in enumerate(r.sample(terms, len(terms) // 2))}
    vocabulary[m.whole_term(["copy", "of", "it"])] = len(vocabulary)
    idf = np.array([1 + r.random() for _ in vocabulary])
    for remembered in (0, 20, 10_000):
        monkeypatch.setattr(m, "REMEMBERED", remembered)
        read = m.Reader(vocabulary, idf)
        for _ in range(150):
            words = r.choices(letters + ["none"], k=r.randint(0, 30))
            (terms_a, weights_a), (terms_b, weights_b) = read(" ".join(words)), m.vector(vocabulary, idf, words)
            assert np.array_equal(terms_a, terms_b) and np.array_equal(weights_a, weights_b)
    assert read("Copy of it")[0].tolist() == [len(vocabulary) - 1] and not len(read("")[0])


def test_search_together_equals_one_by_one(monkeypatch):
    r = random.Random(8)
    monkeypatch.setattr(m, "TOGETHER", 7)
    vocabulary = {f"t{i}": i for i in range(80)}
    idf = np.array([1 + i / 9 for i in range(80)])
    shares = [1 / (1 + i) for i in range(80)]
    draw = lambda n: r.choices(list(vocabulary), shares, k=n)
    examples = [m.vector(vocabulary, idf, draw(r.randint(1, 12))) for _ in range(900)] + [m.vector(vocabulary, idf, ["t1", "t70"])] * 40
    offsets = np.concatenate([[0], np.cumsum([len(t) for t, _ in examples])])
    terms, weights = (np.concatenate(x) for x in zip(*examples))
    queries = [m.vector(vocabulary, idf, draw(r.randint(0, 9))) for _ in range(60)] + [m.vector(vocabulary, idf, ["t70"]), m.vector(vocabulary, idf, ["no"])]
    for block, frequent in ((8, 2), (64, 16), (64, 10_000), (2000, 16)):
        monkeypatch.setattr(m, "BLOCK", block)
        monkeypatch.setattr(m, "FREQUENT", frequent)
        index = m.build_index(vocabulary, idf, list(range(940)), np.zeros(940), offsets, terms, weights, 0.1)
        for k in (1, 15, 2000):
            assert m.Searcher(index)(queries, k) == [m.nearest(index, *q, k) for q in queries]
