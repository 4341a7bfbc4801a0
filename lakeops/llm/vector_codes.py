"""Vector codes by parts: each vector becomes one byte for each of four parts.

Components become integers (floor of 1024 times the component), vectors are cut into equal consecutive
parts, and each part position learns a codebook of integer entries in a fixed number of rounds: every part goes
to its nearest entry, then every entry becomes the floor of the mean of its parts. Integers make each sum
exact, in whatever order tasks add up.

Parts are counted first, so that a round works on distinct parts only, however often one occurs. A task's parts
are sorted, which makes them a trie: parts that begin alike share a node. The trie is traversed depth
first; a node holds the distances of all entries to the components that lead to it, added up once for
everything below. Where a branch has fewer than ``LEAF`` parts, they finish from their node together: the rest
of the distances is a matrix product, then the nearest entry and its weighted sums are taken. Only counts
and sums by entry leave a task. The last assignment runs over the rows in the same way, so no part is
joined back to its vector.

Bounds: a codebook has ``entries`` entries whatever the table's size; they and the sums that replace
them are all that reaches the driver.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped. Vectors shorter than
the longest one, and lengths that the parts don't divide, are continued with zeros. Components beyond
2^43 count as 2^43 (or its negative). Codebooks start from the rows with the smallest ids, a repeated id as often as it
occurs (by its components, then), null ids last; a table with fewer rows has smaller codebooks.
An error or sum that no long can hold is null. Repeated rows get equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import in_slices
from lakeops.operators.joins import key_match
from lakeops.session import settle

SCALE = 1024
LARGEST = 1 << 53  # integers beyond it count as it
LEAF = 8           # parts of a branch that finish together
BLOCK = 2048       # parts whose distances are held at a time


# -- one task's work ------------------------------------------------------------------------------

def exact_type(book: np.ndarray, largest: int) -> type:
    """A type in which squared distances between vectors of components up to ``largest`` are exact."""
    bound = 4 * book.shape[1] * max(largest, 1) ** 2
    return np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object


def assign(parts: np.ndarray, book: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of ``book`` (the first of equals) and squared distance, for sorted ``parts``."""
    kind = exact_type(book, largest)
    parts, book = parts.astype(kind), book.astype(kind)
    n, depths = parts.shape
    codes, errors = np.zeros(n, np.int64), np.zeros(n, kind)
    squares = np.zeros((depths + 1, len(book)), kind)  # of an entry's components from a depth on
    for depth in reversed(range(depths)):
        squares[depth] = squares[depth + 1] + book[:, depth] * book[:, depth]

    def finish(start: int, stop: int, depth: int, gone: np.ndarray) -> None:
        for a in range(start, stop, BLOCK):
            rest = parts[a:min(a + BLOCK, stop), depth:]
            far = gone + squares[depth] - 2 * (rest @ book[:, depth:].T)
            nearest = far.argmin(axis=1)
            codes[a:a + len(rest)] = nearest
            errors[a:a + len(rest)] = far[np.arange(len(rest)), nearest] + (rest * rest).sum(axis=1)

    stack = [(0, n, 0, np.zeros(len(book), kind))]
    while stack:
        start, stop, depth, gone = stack.pop()
        while depth < depths and parts[start, depth] == parts[stop - 1, depth]:
            step = parts[start, depth] - book[:, depth]
            gone = gone + step * step
            depth += 1
        if depth == depths or stop - start <= LEAF:
            finish(start, stop, depth, gone)
            continue
        column = parts[start:stop, depth]
        borders = start + np.flatnonzero(column[1:] != column[:-1]) + 1
        edges = np.concatenate([[start], borders, [stop]])
        big = np.flatnonzero(np.diff(edges) > LEAF)
        at = start  # neighbouring small branches finish together from their common node
        for a, b in zip(edges[big].tolist(), edges[big + 1].tolist(), strict=True):
            if at < a:
                finish(at, a, depth, gone)
            at = b
        if at < stop:
            finish(at, stop, depth, gone)
        stack += [(a, b, depth, gone) for a, b in
                  zip(edges[big][::-1].tolist(), edges[big + 1][::-1].tolist(), strict=True)]
    return codes, errors


def to_keys(parts: np.ndarray, width: int) -> np.ndarray:
    """Rows as bytes (``width`` for each component) that sort like the rows."""
    raised = parts.astype(f"i{width}").view(f"u{width}") ^ np.array(1 << (8 * width - 1), f"u{width}")
    return np.ascontiguousarray(raised.astype(f">u{width}")).view(f"V{width * parts.shape[1]}").reshape(-1)


def from_keys(keys: list[bytes], width: int) -> np.ndarray:
    raised = np.frombuffer(b"".join(keys), f">u{width}").astype(f"u{width}").reshape(len(keys), -1)
    return (raised ^ np.array(1 << (8 * width - 1), f"u{width}")).view(f"i{width}").astype(np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of integers as rows of ``dims``, continued with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _distinct(part: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys of a part position, the row of each, and each row's key."""
    keys = to_keys(part, width)
    order = np.lexsort(part.T[::-1])
    new = np.ones(len(order), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    where = np.empty(len(order), np.int64)
    where[order] = np.cumsum(new) - 1
    return keys[order[new]], order[new], where


# -- jobs -----------------------------------------------------------------------------------------

def _integers(vector: Column) -> Column:
    def whole(x: Column) -> Column:
        wide = x.cast("double") * SCALE
        return F.floor(F.greatest(F.least(wide, F.lit(float(LARGEST))), F.lit(-float(LARGEST))))

    return F.transform(vector, whole)


def _finite(vector: Column) -> Column:
    def fine(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))

    return vector.isNotNull() & F.forall(vector, fine)


def _count_parts(batches: Iterator[pa.RecordBatch], dims: int, parts: int, width: int) -> Iterator[pa.RecordBatch]:
    size = dims // parts
    for batch in in_slices(batches, 4096):
        whole = _matrix(batch.column("ints"), dims)
        for p in range(parts):
            keys, _, where = _distinct(whole[:, p * size:(p + 1) * size], width)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), p, np.int32)), pa.array([k.tobytes() for k in keys], pa.binary()),
                 pa.array(np.bincount(where, minlength=len(keys)).astype(np.int64))], ["position", "part", "n"])


def _sum_parts(batches: Iterator[pa.RecordBatch], books: list[np.ndarray], width: int,
               largest: int) -> Iterator[pa.RecordBatch]:
    """Count (component -1) and sum of each component, for every entry that got a part."""
    sums = [np.zeros((len(b), b.shape[1] + 1), object) for b in books]
    for batch in in_slices(batches, 8192):
        position = batch.column("position").to_numpy()
        for p in np.unique(position):
            mine = batch.filter(pa.array(position == p))
            parts = from_keys(mine.column("part").to_pylist(), width)
            n = mine.column("n").to_numpy()
            codes, _ = assign(parts, books[p], largest)
            exact = np.int64 if int(n.sum()) * max(largest, 1) < 1 << 63 else object
            weight = n[:, None].astype(exact)
            order = np.argsort(codes, kind="stable")
            used, starts = np.unique(codes[order], return_index=True)
            added = np.concatenate([weight, parts.astype(exact) * weight], axis=1)[order]
            sums[p][used] += np.add.reduceat(added, starts, axis=0).astype(object)
    out = [(p, e, k - 1, str(v)) for p, table in enumerate(sums) for e, row in enumerate(table) if row[0]
           for k, v in enumerate(row)]
    columns = list(zip(*out, strict=True)) if out else [()] * 4
    yield pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int32()) for c in columns[:3]), pa.array(columns[3], pa.string())],
        ["position", "entry", "component", "total"])


def _code_rows(batches: Iterator[pa.RecordBatch], books: list[np.ndarray], width: int,
               largest: int) -> Iterator[pa.RecordBatch]:
    size = books[0].shape[1]
    for batch in in_slices(batches, 4096):
        whole = _matrix(batch.column("ints"), size * len(books))
        codes, error = [], np.zeros(len(whole), object)
        for p, book in enumerate(books):
            part = whole[:, p * size:(p + 1) * size]
            _, first, where = _distinct(part, width)
            code, far = assign(part[first], book, largest)
            codes.append(code[where])
            error += (far if far.dtype == object else far.astype(np.int64).astype(object))[where]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"),
             pa.array(["".join(f"{c:02x}" for c in row) for row in zip(*codes, strict=True)], pa.string()),
             pa.array([e if e < 1 << 63 else None for e in map(int, error)], pa.int64())],
            ["vec_id", "label", "code", "error"])


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """One row per kept row of ``vectors`` (vec_id, embedding, label): vec_id, code, error, label_error,
    codebooks_sha256."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's index is written in two hex digits")
    rows = vectors.filter(_finite(F.col("embedding"))).select(
        "vec_id", "label", _integers(F.col("embedding")).alias("ints"))
    top = rows.agg(F.max(F.size("ints")).alias("dims"),
                   F.max(F.array_max(F.transform("ints", F.abs))).alias("largest")).first()
    dims = -(-max(top["dims"] or 0, 1) // parts) * parts
    largest = top["largest"] or 0
    width = 2 if largest < 1 << 15 else 4 if largest < 1 << 31 else 8
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    start = np.zeros((len(seeds), dims), np.int64)
    for row, seed in zip(start, seeds, strict=True):
        row[:len(seed["ints"])] = seed["ints"]
    books = np.split(start, parts, axis=1)

    distinct = settle(
        rows.select("ints").mapInArrow(partial(_count_parts, dims=dims, parts=parts, width=width),
                                       "position int, part binary, n long")
        .groupBy("position", "part").agg(F.sum("n").alias("n"))
        .sortWithinPartitions("position", "part"), "distinct-parts")
    for _ in range(rounds if seeds else 0):
        sums = (distinct.mapInArrow(partial(_sum_parts, books=books, width=width, largest=largest),
                                    "position int, entry int, component int, total string")
                .groupBy("position", "entry", "component")
                .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
        counts = {(r["position"], r["entry"]): int(r["total"]) for r in sums if r["component"] < 0}
        books = [book.copy() for book in books]
        for r in sums:
            if r["component"] >= 0:
                books[r["position"]][r["entry"], r["component"]] = (
                    int(r["total"]) // counts[r["position"], r["entry"]])
    written = ",".join(str(v) for book in books for v in book.reshape(-1).tolist())
    kinds = dict(rows.dtypes)
    coded = settle(rows.mapInArrow(
        partial(_code_rows, books=books, width=width, largest=largest),
        f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), "vector-codes")
    by_label = coded.groupBy("label").agg(
        F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)"))
               .try_cast("bigint")).alias("label_error"))
    return (coded.alias("t").join(by_label.alias("s"), key_match(coded, by_label, [("label", "label")],
                                                                  null_safe=True))
            .select("t.vec_id", "t.code", "t.error", "s.label_error",
                    F.lit(hashlib.sha256(written.encode()).hexdigest()).alias("codebooks_sha256")))
