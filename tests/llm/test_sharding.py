import zlib

import numpy as np
import xxhash

from millrace.llm import sharding as m


def slow_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_moves_only_into_the_new_shard():
    keys = np.random.default_rng(0).integers(0, 1 << 63, 4000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    before = m.jump(keys, 1)
    for n in range(2, 40):
        now = m.jump(keys, n)
        assert now[:300].tolist() == [slow_jump(int(k), n) for k in keys[:300]]
        assert set(now[now != before].tolist()) <= {n - 1}
        before = now
    assert m.jump(keys[:0], 8).tolist() == []


def test_table_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(m, "BUCKET_ROWS", 7)
    rows = [(i, "text é " * (i % 5), "x") for i in range(200)] + [(3, "text", "y"), (3, "text", "y"), (None, None, None), (None, None, None), (500, "", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").selectExpr("*", "1 AS slot", "2 AS size", "3 AS _id")
    got = m.assign_shards(df, 8).collect()
    key = lambda i: 42 if i is None else xxhash.xxh64_intdigest(str(i), 42)
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", slow_jump(key(i), 8), slow_jump(key(i), 9)) for i, t, _ in rows), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in got), key=str) == want
    for shard in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert m.assign_shards(df.limit(0), 8).collect() == []
