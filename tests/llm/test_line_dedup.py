import random

import pytest

from millrace.llm import line_dedup as m


def slow(docs, least):
    """docs: (id, text), ids distinct. All windows of lines, by definition: later copies of runs with enough words go."""
    seqs, out = {}, {}
    for i, text in docs:
        lines = (text or "").split("\n")
        seqs[i] = [(n, x.strip(m.WHITE), len(x.split())) for n, x in enumerate(lines) if x.strip(m.WHITE)]
    first = {}
    for i in sorted(seqs, key=lambda x: (x is not None, x or 0)):
        seq = seqs[i]
        gone = set()
        for a in range(len(seq)):
            for b in range(a, len(seq)):
                run = tuple(x for _, x, _ in seq[a:b + 1])
                if sum(w for *_, w in seq[a:b + 1]) >= least:
                    place = (i is not None, i or 0, a)
                    if first.setdefault(run, place) < place:
                        gone |= set(range(a, b + 1))
        runs, lines = [], (dict(docs)[i] or "").split("\n")
        for j in sorted(gone):
            if runs and runs[-1][1] == j - 1:
                runs[-1][1] = j
            else:
                runs.append([j, j])
        drop = {n for a, b in runs for n in range(seq[a][0], seq[b][0] + 1)}
        text = dict(docs)[i]
        out[i] = (text if not drop else "\n".join(x for n, x in enumerate(lines) if n not in drop), 0 if text is None else len(lines), len(drop))
    return out


def made(seed):
    r = random.Random(seed)
    lines = ["a", "b b", "c c c", "", " ", "d\t", "e e e e e e e", "f " * 12, "g", " g"]
    docs = [(i, "\n".join(r.choices(lines, k=r.randint(0, 14)))) for i in range(25)]
    docs += [(30 + i, "\n".join([f"own{i}", *r.choice(docs)[1].split("\n"), f"end{i}"])) for i in range(10)]
    return docs + [(90, None), (91, ""), (None, docs[3][1]), (92, "\n".join(["a"] * 70)), (93, "z\n" * 3000)]


@pytest.mark.parametrize("least", [1, 4, 9, 50])
@pytest.mark.parametrize("seed", [0, 1])
def test_equals_brute_force(spark, seed, least):
    docs = [d for d in made(seed) if d[0] != 93 or least == 50]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in m.dedup_lines(df, min_words=least).collect()}
    want = slow([d for d in docs if d[0] != 93], least)
    assert {k: v for k, v in got.items() if k != 93} == want


def test_passage_in_other_documents(spark):
    passage = "\n".join(f"line {i} of a passage with quite some words in it" for i in range(6))
    docs = [(1, f"top\n{passage}\nend"), (2, f"other\n{passage}\nmore"), (3, f"{passage}"), (4, "clean line\nanother"), (4, "clean line\nanother")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "length(text) AS row", "1 AS id", "2 AS gone", "3 AS d")
    kept = m.replace_texts(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, docs[0][1]), (2, "other\nmore"), (4, "clean line\nanother"), (4, "clean line\nanother")]


def test_native_and_empty(spark):
    df = spark.createDataFrame(made(0), "doc_id long, text string")
    plan = m.dedup_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    assert m.dedup_lines(df.limit(0)).collect() == [] and m.replace_texts(df.limit(0)).collect() == []
