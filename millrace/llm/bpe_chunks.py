"""Byte-level BPE with reuse of content-defined chunks.

A rolling hash over 32 bytes cuts texts where its low bits are zero, so that equal passages get equal cuts wherever they
stand. Documents are dealt out by the least hash of their chunks, which brings copies and documents with shared passages
together, and each chunk is encoded once in a task, however many documents hold it.

A chunk on its own is encoded as if the text ended there, so the places around a join are encoded again. An anchor is a
space between two visible ASCII characters: the vocabulary's pattern always begins a word there, whatever lies
before, and never looks past it, so tokens on both sides of an anchor do not depend on each other. The text from the
last anchor but one before a join to the second one after it is encoded anew. If its ends agree with the tokens of both
chunks, its middle takes the place of theirs; if not, or if there are no anchors, the window grows to the next chunk and
in the end to the whole text. The result is therefore the encoding of the whole text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import byte_texts, mapped, or_empty

#: Bytes of a chunk: mean of the cuts beyond the least size, and bounds.
MEAN, LEAST, MOST = 1024, 256, 8192
WINDOW = 32
#: Bytes hashed at once; bytes of chunks a task remembers; chunks encoded at once; tokens decoded at once.
PIECE, REMEMBER, CALL, TOKENS = 1 << 20, 8 << 20, 256, 1 << 18
_FACTOR = 0x9E3779B97F4A7C15
#: Split pattern of the vocabulary; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters whose classes may differ between versions of Unicode, and the beginning of a special token.
_BEYOND = re.compile("[^\x00-\u024f]|<\\|")
_ANCHOR = re.compile(rb"(?<=[!-~]) (?=[!-~])")


def _mixed(n: int) -> np.ndarray:
    """n pseudo-random 64-bit numbers by a fixed rule."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_FACTOR)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    return x * np.uint64(0x94D049BB133111EB)


_TABLE = _mixed(256)


def cut_candidates(data: np.ndarray) -> np.ndarray:
    """Places after which the hash of the last ``WINDOW`` bytes asks for a cut, moved to the next start of a character."""
    found = []
    for low in range(0, len(data), PIECE):
        first = max(0, low - WINDOW + 1)
        h = _TABLE[data[first:low + PIECE]]
        width, factor = 1, _FACTOR
        while width < WINDOW:
            grown = h.copy()
            grown[width:] += h[:-width] * np.uint64(factor)
            h, width, factor = grown, 2 * width, factor * factor % (1 << 64)
        found.append(np.flatnonzero((h[low - first:] >> np.uint64(40)) % np.uint64(MEAN) == 0) + low + 1)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunks(text: bytes) -> list[bytes]:
    """The text in content-defined chunks; each begins at a character."""
    if len(text) <= LEAST:
        return [text] if text else []
    data = np.frombuffer(text, np.uint8)
    places = cut_candidates(data).tolist()
    out, low, at, n = [], 0, 0, len(text)
    while low < n:
        while at < len(places) and places[at] < low + LEAST:
            at += 1
        high = min(places[at] if at < len(places) else n, low + MOST, n)
        while high < n and text[high] & 0xC0 == 0x80:
            high += 1
        out.append(text[low:high])
        low = high
    return out


def meeting_key(text: bytes) -> int:
    """The least hash of the text's chunks, signed."""
    return min((xxhash.xxh3_64_intdigest(c) for c in chunks(text)), default=0) - (1 << 63)


class Encoded(NamedTuple):
    """Tokens of a chunk; its anchors nearest to each end as (byte, token) places: outer first, then the next one."""

    tokens: np.ndarray
    head: tuple
    tail: tuple


class ChunkEncoder:
    """Encodes texts with one vocabulary file and remembers the chunks it saw last."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.bytes_of = token_bytes(path)
        self.quick = _by_rank(path, self.bytes_of)
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.known: dict[bytes, Encoded] = {}
        self.size = 0
        self.encoded_chunks = 0

    def plain(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Tokens of each text on its own, in order.

        Where merges are ranks and a text has only characters up to U+024F and no special token, a second library with the
        same vocabulary gives the same tokens several times faster; all other texts go to the file's own library.
        """
        for low in range(0, len(texts), CALL):
            part = [t.decode("utf-8") for t in texts[low:low + CALL]]
            slow = [t for t in part if self.quick is None or _BEYOND.search(t)]
            rest = iter(self.tokenizer.encode_batch_fast(slow, add_special_tokens=False) if slow else ())
            for t in part:
                yield np.array(next(rest).ids if self.quick is None or _BEYOND.search(t) else self.quick.encode_ordinary(t), np.int32)

    def _placed(self, chunk: bytes, tokens: np.ndarray) -> Encoded:
        ends = np.cumsum(self.lengths[tokens])

        def at(byte: int) -> tuple | None:
            token = int(np.searchsorted(ends, byte))
            return (byte, token + 1) if token < len(ends) and ends[token] == byte else None

        head = []
        for m in _ANCHOR.finditer(chunk):
            head.append(at(m.start()))
            if len(head) == 2:
                break
        tail, before = [], len(chunk)
        while len(tail) < 2 and (before := chunk.rfind(b" ", 0, before)) > 0:
            if _ANCHOR.match(chunk, before):
                tail.append(at(before))
        return Encoded(tokens, tuple(head), tuple(tail))

    def remember(self, wanted: list[bytes]) -> dict[bytes, Encoded]:
        """Encodings of the chunks; those not known yet are encoded, each once."""
        new = list(dict.fromkeys(c for c in wanted if c not in self.known))
        own = {c: self.known[c] for c in wanted if c in self.known}
        for chunk, tokens in zip(new, self.plain(new)):
            own[chunk] = self.known[chunk] = self._placed(chunk, tokens)
            self.size += len(chunk)
        self.encoded_chunks += len(new)
        while self.size > REMEMBER and self.known:
            oldest = next(iter(self.known))
            self.size -= len(oldest)
            del self.known[oldest]
        return own

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Tokens of each whole text."""
        cut = [chunks(t) for t in texts]
        known = self.remember([c for parts in cut for c in parts])
        plans = [self._plan([known[c] for c in parts], parts) for parts in cut]
        windows = self.plain([w[0] for plan in plans for w in plan if isinstance(w, tuple)])
        out = []
        for text, plan in zip(texts, plans):
            pieces, whole = [], True
            for part in plan:
                if isinstance(part, tuple):
                    _, left, right = part
                    tokens = next(windows)
                    agrees = len(tokens) >= len(left) + len(right) and np.array_equal(tokens[:len(left)], left) and np.array_equal(tokens[len(tokens) - len(right):], right)
                    whole &= agrees
                    pieces.append(tokens[len(left):len(tokens) - len(right)])
                else:
                    pieces.append(part)
            out.append((np.concatenate(pieces) if pieces else np.zeros(0, np.int32)) if whole else next(self.plain([text])))
        return out

    def _plan(self, encoded: list[Encoded], parts: list[bytes]) -> list:
        """Kept token runs, and between them windows (text, tokens it must begin with, tokens it must end with).

        A chunk keeps its tokens from its first anchor to its last one; the first chunk keeps its beginning, the last
        one its end. A chunk without two anchors on a side that needs them goes into the window as a whole.
        """
        plan, none, last = [], np.zeros(0, np.int32), len(parts) - 1
        window, left = b"", none
        for place, (chunk, e) in enumerate(zip(parts, encoded)):
            needed = ((e.head,) if place else ()) + ((e.tail,) if place < last else ())
            if not all(len(side) == 2 and None not in side for side in needed):
                window += chunk
                if place == last:
                    plan.append((window, left, none))
                continue
            low, high = 0, len(e.tokens)
            if place:
                (_, low), (byte, inner) = e.head
                plan.append((window + chunk[:byte], left, e.tokens[low:inner]))
            if place < last:
                (_, high), (byte, inner) = e.tail
                window, left = chunk[byte:], e.tokens[inner:high]
            plan.append(e.tokens[low:high])
        return plan

    def decode(self, tokens: np.ndarray) -> str:
        """The text of tokens, special ones included; broken characters become U+FFFD."""
        get = self.bytes_of.__getitem__
        return b"".join(b"".join(map(get, tokens[low:low + TOKENS].tolist())) for low in range(0, len(tokens), TOKENS)).decode("utf-8", "replace")


def token_bytes(path: str) -> list[bytes]:
    """The bytes of each token of a byte-level vocabulary file; added tokens stand for their own text."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    vocabulary = spec["model"]["vocab"]
    out = [b""] * (1 + max([*vocabulary.values(), *(a["id"] for a in spec["added_tokens"])]))
    for token, number in vocabulary.items():
        out[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    for added in spec["added_tokens"]:
        out[added["id"]] = added["content"].encode()
    return out


def _by_rank(path: str, bytes_of: list[bytes]):
    """An encoder by ranks, if the file is byte-level with this pattern and its ids count the merges; else None."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocabulary, merges = spec["model"]["vocab"], spec["model"].get("merges", [])
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    level = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or level.get("type") != "ByteLevel" or level.get("add_prefix_space") or not level.get("use_regex", True):
        return None
    if len(vocabulary) - len(merges) not in (256, 256 + len(spec["added_tokens"])) or any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    ranks = {bytes_of[i]: i for i in range(256 + len(merges))}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """One encoder per process and vocabulary file."""
    return ChunkEncoder(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, tokens (array of int) and decoded, the text that these tokens stand for.

    ``path`` names the vocabulary file on every machine. A null text is empty and has no tokens. Rows with a null or
    repeated id are answered one by one. Texts are encoded whole: the tokens are those of the library for the whole text,
    special tokens in it included. Documents are rebalanced by their meeting key, and a key with too many rows is spread
    over several tasks. An empty table gives no rows.
    """
    source = docs.select(F.col(id_col).alias("id"), or_empty(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def keys(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [meeting_key(t) for t in byte_texts(batch.column("text"))]
        return pa.record_batch([batch.column("id"), batch.column("text"), pa.array(found, pa.int64())], ["id", "text", "key"])

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(path)
        tokens = own.encode(byte_texts(batch.column("text")))
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(tokens) if tokens else np.zeros(0, np.int32)))
        return pa.record_batch([batch.column("id"), lists, pa.array([own.decode(t) for t in tokens], pa.string())], ["id", "tokens", "decoded"])

    met = mapped(source, keys, f"id {kind}, text string, key bigint").hint("rebalance", F.col("key"))
    return mapped(met.select("id", "text"), of, f"id {kind}, tokens array<int>, decoded string").withColumnRenamed("id", id_col)


def digest_columns(id_col: str = "doc_id") -> list:
    """Columns over ``encode_decode`` rows: id, token count, SHA-256 of the tokens as decimals and of the decoded text."""
    return [F.col(id_col), F.size("tokens").cast("long").alias("n_tokens"),
            F.sha2(F.array_join(F.col("tokens").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")]


def digest(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return encoded.select(*digest_columns(id_col))
