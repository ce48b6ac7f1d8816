import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import bpe_chunks as m

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    r = random.Random(3)
    words = ["the", "naïve", "'s", "don't", "Straße", "12345", "<|endoftext|>", "  ", "\t", "\n", "\n\n ", "###", "日本語", "emoji🙂", "a" * 300, " ", " x"]
    out = [" ".join(r.choices(words, k=r.randint(0, 900))) for _ in range(40)]
    out += ["".join(r.choices(words, k=900)) for _ in range(10)]
    shared = " ".join(r.choices(words, k=800))
    out += [out[0] + shared + out[1], out[2] + shared, shared]
    return out + ["", " ", "x" * 20000, " " * 9000, "ü" * 9000, "<|endoftext|>" * 1000, "a b" * 5000, "a  b " * 3000]


def test_equals_library(library):
    encoder = m.ChunkEncoder(PATH)
    all_texts = texts()
    for low in range(0, len(all_texts), 7):
        part = all_texts[low:low + 7]
        for text, tokens in zip(part, encoder.encode([t.encode() for t in part])):
            want = library.encode(text, add_special_tokens=False).ids
            assert tokens.tolist() == want
            assert encoder.decode(tokens) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", " ", "  ", "\n", "1", "'s", "'", "#", "é", " ", "<|endoftext|>", "<|", "word"]), max_size=400))
def test_small_chunks(parts):
    text = "".join(parts)
    encoder, library = m.encoder(PATH), m.encoder(PATH).tokenizer
    least, most = m.LEAST, m.MOST
    try:
        m.LEAST, m.MOST = 8, 24
        tokens = encoder.encode([text.encode()])[0]
    finally:
        m.LEAST, m.MOST = least, most
    assert tokens.tolist() == library.encode(text, add_special_tokens=False).ids


def test_every_quick_character(library):
    encoder = m.ChunkEncoder(PATH)
    assert encoder.quick is not None
    for c in map(chr, range(0x250)):
        text = f"a{c}b {c} {c}{c}1 {c}'s  {c}\n{c}"
        assert next(encoder.plain([text.encode()])).tolist() == library.encode(text, add_special_tokens=False).ids


def test_chunks_are_shared_and_encoded_once():
    r = random.Random(1)
    body = " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 9))) for _ in range(9000)).encode()
    a, b = m.chunks(b"first beginning " * 40 + body), m.chunks(b"another " * 60 + body)
    assert b"".join(a) == b"first beginning " * 40 + body and len(set(a) & set(b)) > 0.8 * len(a)
    encoder = m.ChunkEncoder(PATH)
    encoder.encode([body, body])
    encoder.encode([body])
    assert encoder.encoded_chunks == len(set(m.chunks(body)))


def test_memory_of_chunks_is_bounded(monkeypatch):
    monkeypatch.setattr(m, "REMEMBER", 5000)
    encoder = m.ChunkEncoder(PATH)
    encoder.encode([bytes(str(i), "ascii") * 700 for i in range(50)])
    assert encoder.size <= 5000 + m.MOST


def test_table(spark, library):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (None, None, None), (2, "", "y"), (3, "Ünï " * 9000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tokens string").selectExpr("*", "1 AS key", "2 AS decoded", "3 AS id")
    got = sorted((tuple(r) for r in m.digest(m.encode_decode(df, PATH)).collect()), key=str)

    def want(i, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        return i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()
    assert got == sorted((want(i, t) for i, t, _ in rows), key=str)
    assert m.encode_decode(df.limit(0), PATH).collect() == []
