from millrace.llm import language_id as m


def test_every_language_is_learned(spark, monkeypatch):
    texts = {f"l{i:02}": (chr(0x4E00 + 40 * i) + chr(0x4E01 + 40 * i)) * (200 - i) for i in range(70)}
    labelled = spark.createDataFrame(list(texts.items()) + [("zz", "xyzzy " * 1000)], "lang string, text string")
    docs = spark.createDataFrame([(lang, text[:40]) for lang, text in texts.items()] + [("zz", "xyzzy xyzzy"), ("und", "12 3")], "doc_id string, text string")
    trees = m.learn(labelled, train_bytes=3000)
    got = {r["doc_id"]: r for r in m.identify(docs, trees).collect()}
    assert len(got) == 72 and all(r["lang_pred"] == k for k, r in got.items())
    assert {r["doc_id"] for r in m.keep_identified(docs, trees).collect()} == set(texts) | {"zz"}
    monkeypatch.setattr(m, "GROUP_LANGUAGES", 100)
    alone = {r["doc_id"]: r for r in m.identify(docs, m.learn(labelled, train_bytes=3000)).collect()}
    assert all(abs(alone[k][c] - r[c]) < 1e-9 for k, r in got.items() for c in ("score", "bits_per_byte", "margin_bits"))
