"""Byte-level BPE encoding of documents of any length, and decoding.

A long text is cut into overlapping chunks that different tasks work on. Every chunk is split into
pre-tokens from its own first character, which may stand inside a pre-token, so the first boundaries
can be wrong. But where a pre-token ends depends only on what follows its beginning: from the first
boundary on that a chunk shares with its predecessor, both go on alike. So each task also
splits the overlap the way the next chunk does, encodes its chunk up to the first boundary that both
share and that follows no whitespace (how whitespace is split depends on what comes after it), and keeps where its own first pre-tokens begin; putting the chunks together drops the ids
before the boundary that the predecessor chose. A text without a shared boundary in some overlap (one
pre-token longer than the overlap) is encoded in one piece instead. Ids are two bytes each.

Decoding concatenates the bytes of the ids.

Defined results: a null text is empty, has no ids and decodes to nothing. Repeated rows each get a row.
Unpaired surrogates can't occur in Spark strings.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import in_slices
from lakeops.session import settle

MARGIN = 8  # a boundary this close to the end of a chunk may depend on what comes after it

_codecs: dict[tuple[str, str], Codec] = {}


class Codec:
    """Ranks and pattern of a byte-level vocabulary."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        self.tokens = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.space = regex.compile(r"\s")
        self.written = [str(i) for i in range(1 << 16)]

    @classmethod
    def of(cls, path: str, pattern: str) -> Codec:
        if (path, pattern) not in _codecs:
            _codecs[path, pattern] = cls(path, pattern)
        return _codecs[path, pattern]

    def encode(self, text: str) -> list[int]:
        """Ids of a text that begins and ends at boundaries of pre-tokens."""
        return self.tokens.encode_ordinary(text)

    def boundaries(self, text: str, start: int, stop: int) -> list[int]:
        """Where pre-tokens end, split from ``start``, as far as ``text`` settles it before ``stop``."""
        sure, out = len(text) - MARGIN, [start]
        for match in self.pattern.finditer(text, start):
            if match.end() > sure:
                break
            out.append(match.end())
            if match.end() >= stop:
                break
        return out

    def digests(self, ids: list[int]) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of the written ids and of the decoded bytes."""
        written, decoded = hashlib.sha256(), hashlib.sha256()
        for at in range(0, len(ids), 1 << 16):
            part = ids[at:at + (1 << 16)]
            written.update(((" " if at else "") + " ".join([self.written[i] for i in part])).encode())
            decoded.update(self.tokens.decode_bytes(part))
        return len(ids), written.hexdigest(), decoded.hexdigest()


def encode_chunk(codec: Codec, text: str, size: int, overlap: int,
                 last: bool) -> tuple[bytes, list[int], list[int], int]:
    """Ids of one chunk of ``size`` characters, which the overlap follows unless it is the last.

    Returns the ids (two bytes each), the chunk's own first boundaries with the number of ids before
    each, and where the shared boundary with the next chunk stands, counted from that chunk's
    beginning; -1 if there is none.
    """
    own = codec.boundaries(text, 0, overlap if last else len(text))
    end = len(text)
    if not last:
        shared = {b for b in own if b >= size} & set(codec.boundaries(text, size, end))
        end = min((b for b in shared if not codec.space.match(text, b - 1)), default=-1)
        if end < 0:
            return b"", [], [], -1
    heads = [b for b in own if b < min(overlap, end)]
    ids, before = [], []
    for a, b in zip(heads, [*heads[1:], end], strict=True):
        before.append(len(ids))
        ids += codec.encode(text[a:b])
    return np.array(ids, "<u2").tobytes(), heads, before, 0 if last else end - size


def stitch(parts: list[tuple[int, bytes, list[int], list[int], int]], whole: int) -> list[int] | None:
    """Ids of a text from its chunks (number, ids, heads, before, shared) in order; None if some
    chunk doesn't meet its predecessor."""
    out, skip = [], 0
    if [p[0] for p in parts] != list(range(whole)):
        raise ValueError("a chunk is missing")
    for _, ids, heads, before, shared in parts:
        if shared < 0 or skip not in heads:
            return None
        out.append(np.frombuffer(ids, "<u2")[before[heads.index(skip)]:])
        skip = shared
    return np.concatenate(out).tolist()


def encode_documents(docs: DataFrame, ranks: str, pattern: str, chunk: int = 32_768,
                     overlap: int = 1_024) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    short = rows.filter(F.length("text") <= chunk)
    long = rows.filter(F.length("text") > chunk).withColumn("digest", F.md5("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(ranks, pattern)
        for part in in_slices(batches):
            got = [codec.digests(codec.encode(t)) for t in part.column("text").to_pylist()]
            n, ids, decoded = zip(*got, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1):
            text = batch.column("text")[0].as_py()
            starts = range(0, len(text) - overlap, chunk)
            for k, at in enumerate(starts):
                body = text[at:] if k == len(starts) - 1 else text[at:at + chunk + overlap]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("digest"), pa.array([k], pa.int32()),
                     pa.array([len(starts)], pa.int32()), pa.array([body])],
                    ["doc_id", "digest", "number", "chunks", "body"])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(ranks, pattern)
        for part in in_slices(batches, 8):
            out = [encode_chunk(codec, body, chunk, overlap, k == n - 1) for k, n, body in zip(
                *(part.column(c).to_pylist() for c in ("number", "chunks", "body")), strict=True)]
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("doc_id", "digest", "number", "chunks")),
                 pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.list_(pa.int32())),
                 pa.array(columns[2], pa.list_(pa.int32())), pa.array(columns[3], pa.int32())],
                ["doc_id", "digest", "number", "chunks", "ids", "heads", "before", "shared"])

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        codec = Codec.of(ranks, pattern)
        copies = int((group["number"] == 0).sum())  # repeated rows bring every chunk again
        doc = group.drop_duplicates("number").sort_values("number")
        ids = stitch([(r.number, r.ids, list(r.heads), list(r.before), r.shared)
                      for r in doc.itertuples()], int(doc["chunks"].iloc[0]))
        n, written, decoded = codec.digests(ids) if ids is not None else (None, None, None)
        return pd.DataFrame({
            "doc_id": pd.Series([doc["doc_id"].iloc[0]] * copies, dtype=doc["doc_id"].dtype),
            "digest": doc["digest"].iloc[0], "n_tokens": pd.Series([n] * copies, dtype="Int64"),
            "ids_sha256": written, "decoded_sha256": decoded})

    stitched = settle(
        long.mapInArrow(cut, f"doc_id {kind}, digest string, number int, chunks int, body string")
        .repartition("digest", "doc_id", "number")
        .mapInArrow(encoded, f"doc_id {kind}, digest string, number int, chunks int, ids binary, "
                             "heads array<int>, before array<int>, shared int")
        .groupBy("digest", "doc_id").applyInPandas(
            joined, schema.replace("n_tokens", "digest string, n_tokens")), "stitched")
    unmet = stitched.filter("n_tokens IS NULL").select(
        F.col("doc_id").alias("unmet_id"), F.col("digest").alias("unmet_digest"))
    again = long.join(unmet, F.col("doc_id").eqNullSafe(F.col("unmet_id"))
                      & (F.col("digest") == F.col("unmet_digest")), "left_semi").drop("digest")
    return (short.mapInArrow(whole, schema)
            .union(stitched.filter("n_tokens IS NOT NULL").drop("digest"))
            .union(again.mapInArrow(whole, schema)))
