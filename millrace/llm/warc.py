"""Web archives: WARC files written and read by Spark, with a globally ordered index of captures.

Each page becomes one record, a response or a revisit of an equal payload. Archives are text files whose rows end with the
two line ends that end a WARC record. Every archive is read back by its lengths and gives a locally sorted run of
captures (URL key, time, page); runs meet by ranges of (URL key, time) and a loser tree merges those of a range, so
the ranges on end are the capture histories in global order.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from itertools import islice
from urllib.parse import unquote_plus, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import or_empty, scratch, stored

#: Payloads of fewer bytes are always stored whole.
LEAST_SHARED = 1000
#: Bytes of one archive file, about, and captures of one range.
ARCHIVE_BYTES, RANGE_ROWS = 16 << 20, 200_000
#: Time of capture: this plus the page id in seconds, as pages carry none.
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
SPAN_SECONDS = 20 * 365 * 86400

RECORD_END = "\r\n\r\n"
CAPTURE = "url_key string, captured_at string, page_id bigint, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, archive string, offset bigint"
_FIELDS = ("url_key", "captured_at", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "archive", "offset")
_TYPES = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
ARROW = pa.schema(list(zip(_FIELDS, _TYPES)))


# --- writing ---------------------------------------------------------------------------

def with_types(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """``pages`` (page_id, url, html) with payload, size, digest, record_type and refers_to.

    Of equal payloads of ``least`` bytes or more the one with the largest page id is the response, and the others revisit
    it. Rows that share this id and the payload are all responses; null ids count only if there is no other.
    """
    payload = or_empty("html")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), or_empty("url").alias("url"), payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("size"), F.sha1(payload).alias("digest"))
    # Written, so that its size is known before the pages are joined to it: small ones are broadcast and no page moves.
    shared = stored(rows.filter(F.col("size") >= least).select("page_id", "size", "digest").groupBy("digest", "size")
                    .agg(F.max("page_id").alias("owner"), F.count("*").alias("n")).filter("n > 1").select("digest", "size", "owner"), "shared-payloads")
    revisit = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    return (rows.join(shared, ["digest", "size"], "left")
            .select("page_id", "url", "payload", "size", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("owner")).alias("refers_to")))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _record(page: Column, url: Column, size: Column, digest: Column, kind: Column, refers_to: Column, payload: Column) -> Column:
    """One record as text, without its end. Ids and times are made from the page id; a null id is written as '-'."""
    number = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    when = F.date_format(F.timestamp_seconds(F.lit(int(EPOCH.timestamp())) + F.pmod(F.coalesce(page, F.lit(0)), F.lit(SPAN_SECONDS))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n"))
    block = F.when(kind == "revisit", http).otherwise(F.concat(http, payload))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind), _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), number(page), F.lit(">"))),
        _line("WARC-Date", when), _line("WARC-Target-URI", F.url_encode(url)), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(kind == "revisit", F.concat(_line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                                           _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), number(refers_to), F.lit(">"))))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"), _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    return F.concat(head, block)


def write_archives(pages: DataFrame, path: str, least: int = LEAST_SHARED, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes all pages as WARC files below ``path``; each task rolls to a new file about every ``archive_bytes``."""
    typed = with_types(pages, least)
    n, size = pages.agg(F.count("*"), F.sum(F.octet_length("html"))).first()
    per_file = max(1, int(archive_bytes / max(1.0, (size or 0) / max(1, n) + 600)))
    record = _record(*(F.col(c) for c in ("page_id", "url", "size", "digest", "record_type", "refers_to", "payload")))
    typed.select(record.alias("value")).write.option("lineSep", RECORD_END).option("maxRecordsPerFile", per_file).text(path)


# --- reading ---------------------------------------------------------------------------

def records(data: memoryview | bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of each record of an archive, by the lengths in the headers."""
    data, at = bytes(data), 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        begin = stop + 4
        end = begin + int(fields["Content-Length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end at its length")
        yield at, fields, data[begin:end]
        at = end + 4


def payload_of(block: bytes) -> bytes:
    return block[block.index(b"\r\n\r\n") + 4:]


def url_key(url: str) -> str:
    """Host labels from the top level down, then path and query in lower case; scheme, port, 'www.' and fragment do not count."""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}".lower()


def _page(record_id: str | None) -> int | None:
    number = re.fullmatch(r"<urn:page:(-?\d+)>", record_id or "")
    return int(number[1]) if number else None


def _time(date: str) -> str:
    return re.sub(r"[-:TZ]", "", date)


def captures_of(name: str, data: bytes) -> list[tuple]:
    """The captures of one archive as a sorted run. A revisit's size and digest are those of its headers."""
    run = []
    for offset, fields, block in records(data):
        revisit = fields["WARC-Type"] == "revisit"
        payload = payload_of(block)
        size = int(re.search(rb"Content-Length: (\d+)", block)[1]) if revisit else len(payload)
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else hashlib.sha1(payload).hexdigest()
        run.append((url_key(unquote_plus(fields["WARC-Target-URI"])), _time(fields["WARC-Date"]), _page(fields["WARC-Record-ID"]), fields["WARC-Type"],
                    size, digest, _page(fields.get("WARC-Refers-To")), name, offset))
    return sorted(run, key=order_of)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, payload) of all records below ``path``; a revisit has the payload of the record it refers to."""
    def of(batches):
        for batch in batches:
            for data in batch.column("content").to_pylist():
                rows = [(_page(f["WARC-Record-ID"]), f["WARC-Type"], _page(f.get("WARC-Refers-To")), None if f["WARC-Type"] == "revisit" else payload_of(b).decode("utf-8"),
                         f["WARC-Payload-Digest"]) for _, f, b in records(data)]
                yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()))],
                                      ["page_id", "record_type", "refers_to", "payload", "digest"])
    read = _archives(spark, path).mapInArrow(of, "page_id bigint, record_type string, refers_to bigint, payload string, digest string")
    owners = read.filter("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "digest", F.col("payload").alias("_whole")).dropDuplicates(["refers_to", "digest"])
    return read.join(owners, ["refers_to", "digest"], "left").select("page_id", "record_type", F.coalesce("payload", "_whole").alias("payload"))


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def order_of(capture: tuple) -> tuple:
    """URL key, time, page (none first), then place."""
    page = capture[2]
    return capture[0], capture[1], page is not None, page or 0, capture[7], capture[8]


def loser_tree_merge(runs: Iterable[Iterable], key=order_of) -> Iterator:
    """Merges sorted runs: a tournament keeps the loser of each match at its node, so the next row costs one match a level."""
    heads = [iter(r) for r in runs]
    rows = [next(h, None) for h in heads]
    k = len(heads)
    if not k:
        return
    keys = [None if r is None else key(r) for r in rows]

    def beats(a: int, b: int) -> bool:
        if keys[a] is None or keys[b] is None:
            return keys[b] is None and (keys[a] is not None or a < b)
        return (keys[a], a) < (keys[b], b)

    losers, winners = [0] * k, [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    best = winners[1] if k > 1 else 0
    while keys[best] is not None:
        yield rows[best]
        rows[best] = next(heads[best], None)
        keys[best] = None if rows[best] is None else key(rows[best])
        node = (best + k) // 2
        while node:
            if beats(losers[node], best):
                best, losers[node] = losers[node], best
            node //= 2


def _as_batch(rows: list[tuple], extra: list | None = None) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)]
    if extra is None:
        return pa.RecordBatch.from_arrays(columns, schema=ARROW)
    return pa.record_batch([*columns, pa.array(extra, pa.int64())], [*_FIELDS, "place"])


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives below ``path``; those of one archive are a sorted run."""
    def of(batches):
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows = captures_of(name.rsplit("/", 1)[-1], data)
                if rows:
                    yield _as_batch(rows)
    return _archives(spark, path).mapInArrow(of, CAPTURE)


def merged_index(runs: DataFrame) -> DataFrame:
    """All captures with ``place``, their place in the global order, and ``capture_no``, that within their URL key.

    Runs are cut at common borders of (URL key, time, page), so a URL with very many captures spans several ranges.
    Each range merges its parts of the runs; the sizes of the ranges before it give its first place.
    """
    runs = stored(runs, "capture-runs")
    parts = max(1, math.ceil(runs.count() / RANGE_ROWS))

    def merge(batches):
        cut: dict[str, list] = {}
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in _FIELDS)):
                cut.setdefault(row[7], []).append(row)
        for run in cut.values():  # a run may arrive in pieces
            if any(order_of(a) > order_of(b) for a, b in zip(run, run[1:])):
                run.sort(key=order_of)
        merged, at = loser_tree_merge(cut.values()), 0
        while rows := list(islice(merged, 10_000)):
            yield _as_batch(rows, list(range(at, at + len(rows))))
            at += len(rows)

    ranged = runs.repartitionByRange(parts, "url_key", "captured_at", "page_id")
    local = stored(ranged.mapInArrow(merge, f"{CAPTURE}, place bigint").withColumn("part", F.spark_partition_id()), "merged-captures")
    sizes = sorted((r["part"], r["n"]) for r in local.groupBy("part").agg(F.count("*").alias("n")).collect())
    first, before = [], 0
    for part, n in sizes:
        first.append((part, before))
        before += n
    starts = local.sparkSession.createDataFrame(first, "part int, first bigint")
    placed = local.join(starts, "part").withColumn("place", F.col("place") + F.col("first"))
    begin = stored(placed.groupBy("url_key").agg(F.min("place").alias("_begin")), "url-keys")
    return placed.join(begin, "url_key").select(*_FIELDS, "place", (F.col("place") - F.col("_begin") + 1).alias("capture_no"))


def archive_pages(pages: DataFrame, path: str | None = None, least: int = LEAST_SHARED, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``pages`` as archives below ``path`` (a new shared folder if none), reads them back and indexes the captures.

    One row per page: url_key, captured_at, page_id, record_type, payload_bytes, payload_digest (SHA-1 of the whole
    payload), refers_to, archive, offset, place, capture_no. A null html is an empty payload, a null url an empty one; a
    null page id is written as none and read back as null. Repeated rows are records of their own. An empty table gives
    no rows.
    """
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    write_archives(pages, path, least, archive_bytes)
    return merged_index(capture_runs(spark, path))
