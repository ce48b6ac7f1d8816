import hashlib
import importlib

import duckdb
import numpy as np
from test_decontamination import slow_search
from test_shingle_dedup import slow_kept
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import language_id
from millrace.llm.queries import ORACLES

FOLDER = "/root/testdata/sf0.001"


def slow_pipeline(spark):
    """The stages one after the other on plain lists; line dedup by its SQL statement."""
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang").collect()]
    trees = language_id.learn(spark.createDataFrame([(x[2], x[1]) for x in docs], "lang string, text string"))
    data = [(t or "").encode() for _, t, _ in docs]
    bits = language_id.code_lengths(trees, np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]))
    docs = [d for d, b, raw in zip(docs, bits, data) if any(c.isalpha() for c in d[1] or "") and b.min() / 65536 < 8 * len(raw)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [d[:2] for d in docs])
    body = ORACLES["op5_line_dedup"]
    dropped = {}
    for i, at in con.execute(body[:body.rindex("SELECT d.doc_id")] + "SELECT doc_id, removed.at FROM removed").fetchall():
        dropped[i] = set(at)
    docs = [(i, t if i not in dropped else "\n".join(x for n, x in enumerate(t.split("\n"), 1) if n not in dropped[i])) for i, t, _ in docs]
    docs = [d for d in docs if d[0] not in dropped or d[1].strip(" \t\r\x0b\x0c\n")]
    kept = set(slow_kept(docs))
    docs = [d for d in docs if d[0] in kept]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [d for d in docs if not slow_search(items, d[1])]
    library = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    out = []
    for i, t in docs:
        ids = library.encode(t, add_special_tokens=False).ids
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out)


def test_stages_equal_brute_force(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert sorted(tuple(r) for r in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == slow_pipeline(spark)


def test_stages_keep_columns_and_take_nulls(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a b c", "en", "s", 5), (2, "a b c", "en", "s", 5), (3, "12 34", None, "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, FOLDER)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert now.columns == docs.columns
        assert [r["doc_id"] for r in now.collect()] == ([] if empty else [2])


def test_entry_without_corpus_operators(monkeypatch):
    import __spark_entry__ as entry
    assert "pipeline" in entry.queries() and [n for n in entry.queries() if n.startswith("op")]

    def missing(name):
        raise ImportError(name)
    monkeypatch.setattr(importlib, "import_module", missing)
    assert "pipeline" not in entry.queries() and "fct_daily_sales" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
