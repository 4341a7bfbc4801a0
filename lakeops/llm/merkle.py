"""Document fingerprints: a Merkle tree over sections, paragraphs and runs of words.

A paragraph is a line. A section begins at a blank line or at a heading (a line that begins with
``#``). Leaves are runs of four words of a paragraph, single words where it has 16 at most; runs
of more than 128 characters are cut into pieces of 64. Every inner node is the digest of its children's digests, so equal roots mean equal texts,
and where roots differ, going down into the differing children alone locates the edit.

The likeness of two trees is the share of characters that stand in leaves both have
(twice the shared characters by the sum of both sizes): 1 for equal roots, 0 without a common leaf.

Comparing each document with its successor by id needs no global sort: ids are cut into ranges
by approximate percentiles, every range also gets the first document of the next one, and inside a
range the rows stream in order of id.

Defined results: a null text is empty; two empty texts have likeness 1. Rows with equal ids
follow each other by the hash of their text, and null ids come first. The successor of the only
row is the row itself.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import in_slices, range_of
from lakeops.operators.joins import plan_bytes

BYTES_PER_RANGE = 1 << 30  # of the planner's estimate

WORDS, FEW, LONG, PIECE = 4, 16, 128, 64


@dataclass
class Node:
    digest: bytes
    start: int
    end: int
    children: list[Node]


def _digest(level: bytes, parts: bytes) -> bytes:
    return hashlib.blake2b(parts, digest_size=16, person=level).digest()


def _leaves(paragraph: str) -> list[tuple[bytes, int]]:
    """(digest, characters) of the runs of words; the blank after a run counts with it."""
    words, out = paragraph.split(" "), []
    step = 1 if len(words) <= FEW else WORDS
    for i in range(0, len(words), step):
        run = " ".join(words[i:i + step])
        size = len(run) + (i + step < len(words))
        if len(run) > LONG:
            while len(run) > PIECE:
                out.append((_digest(b"piece", run[:PIECE].encode()), PIECE))
                run, size = run[PIECE:], size - PIECE
        out.append((_digest(b"run", run.encode()), size))
    return out


class Tree:
    """The tree of one text, built once; nodes below the root are kept as digests and sizes."""

    def __init__(self, text: str):
        self.size = len(text)
        self.sections: list[list[tuple[bytes, list[tuple[bytes, int]]]]] = [[]]
        for line in text.split("\n"):
            if self.sections[-1] and (line.startswith("#") or not line.strip()):
                self.sections.append([])
            leaves = _leaves(line)
            self.sections[-1].append((_digest(b"paragraph", b"".join(d for d, _ in leaves)), leaves))
        self.digests = [_digest(b"section", b"".join(d for d, _ in s)) for s in self.sections]
        self.root = _digest(b"document", b"".join(self.digests))

    def leaves(self) -> Counter:
        """Characters by leaf digest."""
        out: Counter = Counter()
        for section in self.sections:
            for _, leaves in section:
                for digest, size in leaves:
                    out[digest] += size
        return out

    def nodes(self) -> Node:
        """The same tree with places, for going down."""
        at, sections = 0, []
        for digest, section in zip(self.digests, self.sections, strict=True):
            first, paragraphs = at, []
            for own, leaves in section:
                begin, low = at, []
                for leaf, size in leaves:
                    low.append(Node(leaf, at, at + size, []))
                    at += size
                paragraphs.append(Node(own, begin, at, low))
                at += 1  # the line break
            sections.append(Node(digest, first, at - 1, paragraphs))
        return Node(self.root, 0, self.size, sections)


def likeness(a: Tree, b: Tree, of_a: Counter | None = None, of_b: Counter | None = None) -> float:
    if a.root == b.root:
        return 1.0
    x, y = of_a if of_a is not None else a.leaves(), of_b if of_b is not None else b.leaves()
    total = x.total() + y.total()
    if total == 0:
        return 0.0
    if len(y) < len(x):
        x, y = y, x
    return 2 * sum(min(size, y[d]) for d, size in x.items() if d in y) / total


def edits(old: Node, new: Node) -> list[tuple[int, int]]:
    """Places in the new text that differ, by going down where digests differ."""
    if old.digest == new.digest:
        return []
    a, b = old.children, new.children
    if not a or not b:
        return [(new.start, new.end)]
    head = 0
    while head < min(len(a), len(b)) and a[head].digest == b[head].digest:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail].digest == b[-1 - tail].digest:
        tail += 1
    mid_a, mid_b = a[head:len(a) - tail], b[head:len(b) - tail]
    if len(mid_a) == len(mid_b):
        found = [e for x, y in zip(mid_a, mid_b, strict=True) for e in edits(x, y)]
    elif mid_b:
        found = [(mid_b[0].start, mid_b[-1].end)]
    else:  # something was taken out here
        place = b[head].start if head < len(b) else new.end
        found = [(place, place)]
    return found


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (the root) and ``sections`` (their digests, in order)."""
    @F.arrow_udf("fingerprint string, sections array<string>")
    def tree(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for chunk in texts:
            trees = [Tree(t.as_py() or "") for t in chunk]
            yield pa.StructArray.from_arrays(
                [pa.array([t.root.hex() for t in trees], pa.string()),
                 pa.array([[d.hex() for d in t.digests] for t in trees], pa.list_(pa.string()))],
                ["fingerprint", "sections"])

    return docs.select("doc_id", tree.asNondeterministic()("text").alias("t")).select("doc_id", "t.*")


def locate_edits(old: DataFrame, new: DataFrame) -> DataFrame:
    """doc_id and ``edits`` (start, end in the new text) of documents whose text changed."""
    @F.arrow_udf("array<struct<start:long,end:long>>")
    def places(before: pa.Array, after: pa.Array) -> pa.Array:
        found = [[{"start": s, "end": e} for s, e in
                  edits(Tree(a.as_py() or "").nodes(), Tree(b.as_py() or "").nodes())]
                 for a, b in zip(before, after, strict=True)]
        return pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))

    both = (old.select("doc_id", F.col("text").alias("old"))
            .join(new.select("doc_id", F.col("text").alias("new")), "doc_id")
            .filter(~F.col("old").eqNullSafe(F.col("new"))))
    return both.select("doc_id", places("old", "new").alias("edits"))


def _in_order(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows by range of ids, in order; after a range's rows the first of the next one (``guest``)."""
    first_of_all = F.lit(-(1 << 63))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("bigint"), first_of_all).alias("at"))
    steps = [i / ranges for i in range(1, ranges)]
    cuts = (rows.agg(F.percentile_approx("at", steps, 20 * ranges)).first()[0] or []) if steps else []
    rows = rows.withColumn("part", range_of(F.col("at"), sorted(set(cuts)), "bigint"))
    firsts = sorted((r["part"], r["at"]) for r in rows.groupBy("part").agg(F.min("at").alias("at")).collect())
    if not firsts:
        return rows.select("doc_id", "text", "part", F.lit(False).alias("guest"))
    # Where the first row of each range also goes: to the range before it, around the end. One row a range.
    guests = F.broadcast(docs.sparkSession.createDataFrame(
        [(at, firsts[i - 1][0]) for i, (_, at) in enumerate(firsts)], "first bigint, before int"))
    home = F.struct(F.col("part").cast("int").alias("part"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("before").alias("part"), F.lit(True).alias("guest"))
    placed = rows.join(guests, F.col("at") == F.col("first"), "left").select("doc_id", "text", "at", F.explode(
        F.when(F.col("first").isNotNull(), F.array(home, visit)).otherwise(F.array(home))).alias("to"))
    return (placed.select("doc_id", "text", "at", "to.part", "to.guest").repartition(ranges, "part")
            .sortWithinPartitions("part", "guest", "at", F.xxhash64("text"))
            .select("doc_id", "text", "part", "guest"))


def compare_with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """For each row: its fingerprint, that of its text with the last quarter replaced from the next
    document, and how alike the tree is to the edited text's and to the next document's."""
    if ranges is None:
        ranges = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                     -(-plan_bytes(docs) // BYTES_PER_RANGE))
    kind = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, kinds = None, [pa.int64()]
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            types = [kinds[0], pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)

        for batch in in_slices(batches, 64):
            kinds[0] = batch.schema.field("doc_id").type
            for doc_id, text, part, guest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if guest and (pending is None or pending[0] != part):
                    continue  # a repeated row of the guest: its range is done
                tree = Tree(text)
                leaves = tree.leaves()
                if pending is not None:
                    _, own_id, own, own_tree, own_leaves = pending
                    size = len(own) // 4
                    edited = own[:len(own) - size] + text[:size]
                    other = Tree(edited)
                    held.append((
                        own_id, len(own), hashlib.sha256(edited.encode()).hexdigest(),
                        own_tree.root.hex(), other.root.hex(),
                        likeness(own_tree, other, own_leaves), likeness(own_tree, tree, own_leaves, leaves)))
                    if len(held) == 1024:
                        yield out()
                        held = []
                pending = None if guest else (part, doc_id, text, tree, leaves)
        if held:
            yield out()

    return _in_order(docs, ranges).mapInArrow(
        compare, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
                 "edited_fingerprint string, near_edited double, near_next double")
