"""Near-duplicate detection with SimHash fingerprints and pigeonhole blocks.

A fingerprint has 64 bits; two documents are linked when theirs differ in at most ``max_bits``. The
bits are cut into ``blocks`` blocks. Two linked fingerprints differ in at most ``max_bits`` blocks,
so they agree on some choice of ``blocks - max_bits`` whole blocks: every choice is a bucket key,
buckets are joined with themselves, and each pair's Hamming distance is verified. Equal
fingerprints are merged before, so a group of exact copies is one row.

A bucket of more than ``max_bucket`` different fingerprints isn't joined with itself. There, every
fingerprint meets the others over its one-bit variants (inside the bits in which the bucket's
members can differ): two of them are at most two bits apart exactly if they share a variant, and all
that share one are linked to its smallest member. That is exact for ``max_bits`` = 2 and grows
with the bucket, not with its square.

Linked fingerprints are followed to components by alternating large-star and small-star steps.

Defined results: a null text is empty; texts without a word have fingerprint zero and are
linked like others. Repeated rows share fingerprint and component. Null ids are passed over when
the smallest id is looked for; a component without any id has a null ``component_id``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.operators.joins import key_match
from lakeops.session import settle

SEED = 42
RUN = 1 << 15  # shingles of a long text that are held at a time


def simhash(text: str | None, width: int = 3) -> int:
    """The fingerprint of a text, as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    ends = ends[width - 1:] or ends[-1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(ends), RUN):
        got = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + RUN],
                                                                  ends[at:at + RUN])], "<u8")
        bits = np.unpackbits(got.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(ends), bitorder="little").view("<u8")[0])


def simhash_of(width: int):
    """A function of a text column that gives the fingerprint as a signed long."""
    @F.arrow_udf("long")
    def fingerprint(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for chunk in texts:
            out = np.fromiter((simhash(t.as_py(), width) for t in chunk), np.uint64, len(chunk))
            yield pa.array(out.view(np.int64), pa.int64())
    return fingerprint


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, text_hash (names the text beside the id) and fp of every row."""
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
                       simhash_of(width)("text").alias("fp"))


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """One mask for each choice of whole blocks that a linked pair can agree on."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(choice) for choice in combinations(block, blocks - max_bits)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(points: DataFrame, max_bits: int = 2, blocks: int = 5, max_bucket: int = 200) -> DataFrame:
    """Pairs (a, b) that connect all of the distinct ``fp`` within ``max_bits`` of each other."""
    if max_bits > 2:
        raise ValueError("large buckets are exact for two bits at most")
    masks = block_masks(blocks, max_bits)
    keyed = points.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"))
        for i, m in enumerate(masks)])).alias("bucket")).select("fp", "bucket.*")
    sizes = keyed.groupBy("choice", "part").agg(F.count("*").alias("size")).filter("size > 1")
    keyed = keyed.join(sizes, ["choice", "part"])
    small = keyed.filter(F.col("size") <= max_bucket)
    left = small.select("choice", "part", F.col("fp").alias("a"))
    right = small.select("choice", "part", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = (left.join(right, ["choice", "part"]).filter((F.col("a") < F.col("b")) & near)
             .select("a", "b"))
    free = F.element_at(F.array(*[
        F.array(*[F.lit(_signed(1 << bit)) for bit in range(64) if not m >> bit & 1])
        for m in masks]), F.col("choice") + 1)
    variants = keyed.filter(F.col("size") > max_bucket).select(
        "fp", F.explode(F.concat(F.array("fp"), F.transform(
            free, lambda flip: F.col("fp").bitwiseXOR(flip)))).alias("variant")).distinct()
    hubs = variants.groupBy("variant").agg(F.min("fp").alias("a"), F.count("*").alias("n"))
    stars = (variants.join(hubs.filter("n > 1"), "variant").filter("a < fp")
             .select("a", F.col("fp").alias("b")))
    return pairs.union(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b): a row (node, root) for each node but the roots.

    Large-star points the greater neighbours of a node at its smallest neighbour, small-star the
    smaller ones; both keep connectivity, and repeated in turn they end with stars. Every round
    is written to the shared folder, so lineage stays short and lost executors cost one round.
    """
    stars = settle(edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
                   .distinct(), "stars")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first())

    before = state(stars)
    while before[0]:
        both = stars.union(stars.select("root", "node"))
        low = both.groupBy("node").agg(F.min("root").alias("low"))
        # The root of a large component is a hot node: key_match lets AQE split it.
        large = (both.alias("t").join(low.alias("s"), key_match(both, low, [("node", "node")]))
                 .select("t.node", "t.root", "s.low").filter(F.col("root") > F.col("node"))
                 .select(F.col("root").alias("node"), F.least("low", "node").alias("root")).distinct())
        low = large.groupBy("node").agg(F.min("root").alias("low"))
        small = (large.alias("t").join(low.alias("s"), key_match(large, low, [("node", "node")]))
                 .select("t.node", "t.root", "s.low").select(
            F.explode(F.array(F.struct(F.col("node"), F.col("low").alias("root")),
                              F.struct(F.col("root").alias("node"), F.col("low").alias("root"))))
            .alias("e")).select("e.*").filter("node > root").distinct())
        stars = settle(small, "stars")
        now = state(stars)
        if now == before:
            break
        before = now
    return stars


def group_members(found: DataFrame, max_bits: int = 2, blocks: int = 5,
                  max_bucket: int = 200) -> DataFrame:
    """For each distinct fp of ``found`` (doc_id, fp): the component's smallest doc_id."""
    points = found.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    stars = components(links(points.select("fp"), max_bits, blocks, max_bucket))
    rooted = (points.join(stars.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "doc_id", F.coalesce("root", "fp").alias("root")))
    first = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(first, "root").select("fp", "root", "component_id")


def near_copies(docs: DataFrame, width: int = 3, max_bits: int = 2, **tuning: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (hex), component_id."""
    found = settle(fingerprints(docs, width), "fingerprints")
    groups = group_members(found, max_bits, **tuning)
    return found.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, width: int = 3, max_bits: int = 2, **tuning: int) -> DataFrame:
    """The row with the smallest id of each component, with all columns of ``docs``."""
    found = settle(fingerprints(docs, width), "fingerprints")
    groups = group_members(found, max_bits, **tuning)
    chosen = (found.join(groups, "fp").groupBy("root")
              .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("row"))
              .select(F.col("row.doc_id").alias("_llm_id"), F.col("row.text_hash").alias("_llm_hash")))
    mark = docs.withColumn("_llm_own", F.xxhash64(F.coalesce("text", F.lit(""))))
    kept = mark.join(chosen, mark["doc_id"].eqNullSafe(chosen["_llm_id"])
                     & (mark["_llm_own"] == chosen["_llm_hash"]), "left_semi")
    # Repeated rows of a chosen document: one of them, the same one each time.
    rest: list[Column] = [F.col(c) for c, kind in docs.dtypes
                          if c in ("lang", "source", "n_chars") and "map" not in kind]
    order = Window.partitionBy("doc_id", "_llm_own").orderBy(*rest, "doc_id")
    return (kept.withColumn("_llm_n", F.row_number().over(order)).filter("_llm_n = 1")
            .drop("_llm_n", "_llm_own"))
