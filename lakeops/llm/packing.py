"""Sequence packing along a space-filling curve.

Every document becomes token ids with an end id. The hashed bag of its ids is projected to a few
dimensions with fixed random signs, each coordinate is cut into bins, and the cell's position on a
Hilbert curve is the document's key: documents with similar tokens get nearby keys. The table is
range-sorted by key, and inside each range the documents are laid end to end and cut every
``length`` ids, so neighbours on the curve share sequences. What is left at the end of a range is cut
into runs of powers of two, which need no padding.

Texts are tokenised word by word through a bounded cache, and a new word piece by piece; pieces never
interact in a vocabulary with word ends (its pattern doesn't cross them), so the ids are those of the whole
text.

Defined results: a null text is empty, and has the end id alone. Rows with the same doc_id and text
are packed each for itself. ``sequence_id`` is unique, not dense. An empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import in_slices, letters_of_bytes
from lakeops.session import settle

END_ID = 1
DIMENSIONS, BITS = 4, 8
CACHED_WORDS = 1_200_000

# Lower-case letters of Latin-1. In texts of Latin-1 characters without the exceptions below,
# the vocabulary's pattern cuts exactly where a run of letters, or of other marks, ends.
_LETTERS = "a-zªµºß-öø-ÿ"
_PIECE = re.compile(f"[{_LETTERS}]+|[^{_LETTERS}\\s]+")
_LETTER_RUN = re.compile(f"[{_LETTERS}]+")
# Contractions, unusual white space, and what isn't Latin-1.
_UNUSUAL = re.compile("['\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0]|[^\x00-\xff]")
_BYTE_LETTER = letters_of_bytes()

_coders: dict[str, PieceCoder] = {}


class PieceCoder(dict):
    """Token ids of texts as little-endian unsigned 16-bit numbers, by a cache of words.

    A word stands between blanks and has the same ids in any text. A new one is cut into pieces, runs of letters
    or of other marks; a run of letters is merged by the model alone. The cache has two generations: the
    older one goes when the younger is full, without the words that were met since.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model
        if max(self.tokenizer.get_vocab().values()) >= 1 << 16:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        self.older: dict[str, bytes] = {}
        if not self.model.end_of_word_suffix or any(
                self[w] != _packed(self.tokenizer.encode(w, add_special_tokens=False).ids) for w in ("plain", "größe")):
            raise ValueError("the model of this vocabulary doesn't close every word by itself")

    @classmethod
    def of(cls, path: str) -> PieceCoder:
        if path not in _coders:
            _coders[path] = cls(path)
        return _coders[path]

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if word.isalpha() and word.isascii():
                ids = _packed([t.id for t in self.model.tokenize(word.lower())])
            elif _LETTER_RUN.fullmatch(word):
                ids = _packed([t.id for t in self.model.tokenize("".join(map(_BYTE_LETTER.__getitem__, word.encode())))])
            elif len(pieces := self.pieces(word)) > 1:
                ids = b"".join([self[p] for p in pieces])
            else:
                ids = _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        self[word] = ids
        return ids

    @staticmethod
    def pieces(word: str) -> list[str]:
        """The pieces of a word of plain Latin-1 characters; none if it has others."""
        return [] if _UNUSUAL.search(word) else _PIECE.findall(word.lower())

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if len(self) > CACHED_WORDS // 2:
                self.older = dict(self)
                self.clear()
            if _UNUSUAL.search(text):
                words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            else:
                words = text.lower().split()
            out.append(b"".join(map(self.__getitem__, words)))
        return out


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}H", *ids)


def projection(seed: int = 11, buckets: int = 4096) -> np.ndarray:
    """For each id, what it adds to each dimension, and the square of its weight.

    An id adds the random signs of its hash bucket. Frequent tokens have low ids in a BPE vocabulary,
    and weigh less.
    """
    rng = np.random.default_rng(seed)
    signs = rng.choice(np.array([-1.0, 1.0]), (buckets, DIMENSIONS))
    ids = np.arange(1 << 16, dtype=np.uint64)
    bucket = (ids * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(buckets)
    weight = (0.02 + ids / len(ids))[:, None]
    return np.hstack([signs[bucket] * weight, weight ** 2]).astype(np.float32)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of rows of ``dimensions`` cell numbers below ``2 ** bits``.

    Undoes the curve's rotations and reflections from the top bit down, then the Gray code, and
    interleaves the bits (Skilling's method), for all rows at once.
    """
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q, below = 1 << level, (1 << level) - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(high, x[0] ^ below, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] & (1 << level), (1 << level) - 1, 0)
    x = [v ^ flip for v in x]
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for v in x:
            key = (key << 1) | ((v >> level) & 1)
    return key


def curve_keys(coded: list[bytes], table: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents given by their ids."""
    sizes = np.array([len(c) // 2 for c in coded])
    spot = np.zeros((len(coded), DIMENSIONS))
    some = np.flatnonzero(sizes)
    if len(some):
        ids = np.frombuffer(b"".join(coded), "<u2")
        sums = np.add.reduceat(table[ids], (np.cumsum(sizes) - sizes)[some], axis=0)
        spot[some] = sums[:, :DIMENSIONS] / np.sqrt(sums[:, DIMENSIONS:])
    # For unrelated signs each coordinate is near normal: its distribution function fills the bins.
    share = 1 / (1 + np.exp(-1.702 * np.clip(spot, -20, 20)))
    return hilbert_key(np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


def tokenised(docs: DataFrame, vocabulary: str, part_ids: int = 4096) -> DataFrame:
    """The ids of every row (16-bit, with the end id) in parts of ``part_ids``: doc_id, curve key,
    start, tokens of the document, ids. So a row is never larger than a part, however long a text."""
    end = np.array([END_ID], "<u2").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, table = PieceCoder.of(vocabulary), projection()
        for batch in in_slices(batches, 128):
            coded = coder.encode([t or "" for t in batch.column("text").to_pylist()])
            keys = curve_keys(coded, table)
            rows = [(i, start, len(c) // 2 + 1, (c + end)[2 * start:2 * (start + part_ids)])
                    for i, c in enumerate(coded) for start in range(0, len(c) // 2 + 1, part_ids)]
            index, starts, tokens, ids = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(index, pa.int64())), pa.array(keys[list(index)], pa.int64()),
                 pa.array(starts, pa.int64()), pa.array(tokens, pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "curve", "start", "tokens", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind}, curve long, start long, tokens long, ids binary")


def pack_run(rows: Iterator[tuple], length: int) -> Iterator[tuple]:
    """Lay (doc_id, start, doc tokens, ids) end to end;
    (doc_id, start, length, crc, doc tokens, sequence, offset) for each piece."""
    sequence = offset = 0
    open_pieces: list[tuple] = []  # doc_id, start, doc tokens, list of ids; of the sequence that isn't full
    for doc_id, start, tokens, ids in rows:
        while len(ids):
            own, ids = ids[:length - offset], ids[length - offset:]
            before = open_pieces[-1] if open_pieces else None
            if (before and before[0] == doc_id and before[2] == tokens
                    and before[1] + sum(map(len, before[3])) == start):
                before[3].append(own)  # the next part of the same document
            else:
                open_pieces.append((doc_id, start, tokens, [own]))
            start, offset = start + len(own), offset + len(own)
            if offset == length:
                yield from _placed(open_pieces, [length], sequence)
                sequence, offset, open_pieces = sequence + 1, 0, []
    powers = [1 << b for b in range(offset.bit_length() - 1, -1, -1) if offset >> b & 1]
    yield from _placed(open_pieces, powers, sequence)


def _placed(pieces: list[tuple], sizes: list[int], sequence: int) -> Iterator[tuple]:
    """Cut pieces at the ends of sequences of the given sizes, which together they fill."""
    at, room = 0, list(sizes)
    for doc_id, start, tokens, runs in pieces:
        ids = np.concatenate(runs).astype("<u4")
        done = 0
        while done < len(ids):
            size = min(len(ids) - done, room[0] - at)
            yield (doc_id, start + done, size, zlib.crc32(ids[done:done + size].tobytes()), tokens, sequence, at)
            done, at = done + size, at + size
            if at == room[0]:
                room.pop(0)
                sequence, at = sequence + 1, 0


def pack(docs: DataFrame, vocabulary: str, length: int = 2048, ids_per_range: int = 4_000_000) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    coded = settle(tokenised(docs, vocabulary), "tokens")
    total = coded.agg(F.sum(F.length("ids"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (2 * ids_per_range)))
    # Equal keys (copies, empty texts) may be a third of all rows: the id's hash splits them. Ranges
    # hold even numbers of parts, so long documents weigh no more in one than in another.
    tie = F.xxhash64("doc_id")
    ranged = (coded.withColumn("tie", tie).repartitionByRange(ranges, "curve", "tie", "start")
              .sortWithinPartitions("curve", "tie", "doc_id", "start", "ids")
              .select(F.spark_partition_id().alias("part"), "doc_id", "start", "tokens", "ids"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names[1:])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, id_type = [0], [pa.int64()]

        def rows() -> Iterator[tuple]:
            for batch in in_slices(batches):
                own[0], id_type[0] = batch.column("part")[0].as_py(), batch.schema.field("doc_id").type
                for *row, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "tokens")),
                                     batch.column("ids"), strict=True):
                    yield *row, np.frombuffer(ids.as_buffer(), "<u2")

        def batch_of(held: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*held))
            columns[5] = [(own[0] << 40) + s for s in columns[5]]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type[0]), *[pa.array(c, pa.int64()) for c in columns[1:]]], names)

        held: list[tuple] = []
        for piece in pack_run(rows(), length):
            held.append(piece)
            if len(held) == 4096:
                yield batch_of(held)
                held = []
        if held:
            yield batch_of(held)

    return ranged.mapInArrow(cut, schema)
