import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import pii as m


def slow_base(text):
    """The contract's patterns, read literally."""
    out = []
    for x in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *x.span()))
    for x in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in x[0].split(".")):
            out.append(("ip", *x.span()))
    for x in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", x[0])
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
        if 13 <= len(digits) <= 19 and sum(v // 10 + v % 10 for v in twice) % 10 == 0:
            out.append(("card", *x.span()))
    for x in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", x[0])) <= 15:
            out.append(("phone", *x.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a.b", "@", "x-1", ".", "..", "1", "255", "256", "010", " ", "-", "+", "4111111111111111", "(", ")", "é", "٣", "\n", "2.2.2"]), max_size=25))
def test_base_spans_follow_the_patterns(parts):
    text = "".join(parts)
    assert [(s.kind, s.start, s.end) for s in m.find_spans(text) if s.kind in m.BASE] == slow_base(text)


def test_checksums_and_context():
    assert m.luhn("4111111111111111") and not m.luhn("4111111111111112")
    assert m.mod97("DE89370400440532013000") and not m.mod97("DE89370400440532013001")
    kinds = lambda t: [(s.kind, t[s.start:s.end]) for s in m.find_spans(t)]
    assert ("iban", "DE89 3704 0044 0532 0130 00") in kinds("pay DE89 3704 0044 0532 0130 00 NOW or")
    secret = "a1" * 20
    assert kinds(f"token = \"{secret}\"") == [("secret", secret)] and kinds(f"digest {secret}") == []
    assert m.find_spans("call +1 (743) 555-3824")[0].score > m.find_spans("the +1 (743) 555-3824")[0].score


def test_long_texts_are_linear():
    for piece in ("1" * 200_000, "1." * 100_000, "a" * 300_000, "a@" * 100_000, "1 " * 100_000, "A" * 200_000, "f" * 200_000 + "1"):
        m.find_spans(piece)


def test_table(spark):
    rows = [(1, "mail a@b.co now", "x"), (1, "mail a@b.co now", "x"), (None, None, None), (2, "", ""), (3, "🙂 ip 10.0.0.1", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string").selectExpr("*", "1 AS id", "2 AS kind")
    got = sorted((tuple(r) for r in m.digest(m.detect_pii(df)).collect()), key=str)

    def want(i, text):
        base = slow_base(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        return (i, *[sum(k == kind for k, _, _ in base) for kind in m.BASE], hashlib.sha256(joined.encode()).hexdigest(), joined)
    assert got == sorted((want(i, t) for i, t, _ in rows), key=str)
    assert m.detect_pii(df.limit(0)).collect() == []


def test_query_equals_brute_force(spark):
    from millrace.llm.queries import QUERIES
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op8_pii"](spark, folder).collect():
        base = slow_base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert set(f"{k}:{a}:{b}" for k, a, b in base) <= set(r["spans"].split(","))
