"""Quality rules as a ledger of bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit for each rule
that failed. A policy is a versioned mask of rules; applying one, or asking what a rule alone
costs, reads the bits and never the texts again.

Defined results: a null text has no words; it and an empty text fail ``few_words``. Repeated rows get equal
rows. Words are runs without the ASCII white space 0x20 and 0x09 to 0x0D. An empty table gives an
empty ledger, and an ablation of zeros.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
SYMBOLS = b"#*$%&|<>"


def measure(text: str | None) -> tuple[int, ...]:
    """One number for each of ``MEASURES``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    chars = len(text or "") - (len(raw) - sum(map(len, words)))
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        times, reach = Counter(windows), 0
        for i, w in enumerate(windows):
            if times[w] > 1:
                repeated += i + 3 - max(i, reach)
                reach = i + 3
    return (len(words), chars, sum(raw.count(s) for s in SYMBOLS), len(lines) - len(set(lines)),
            repeated, len(lines))


def measured():
    """A function of a text column that gives all measurements."""
    @F.arrow_udf(", ".join(f"{m} long" for m in MEASURES))
    def take(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for chunk in texts:
            columns = list(zip(*(measure(t.as_py()) for t in chunk), strict=True)) or [()] * len(MEASURES)
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(MEASURES))
    return take.asNondeterministic()


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL condition over the measurements


# Appended to, never reordered: the position is the rule's bit.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self) -> int:
        bits = {r.name: 1 << i for i, r in enumerate(RULES)}
        return sum(bits[r] for r in set(self.rules))


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STRICT = Policy("strict", 1, tuple(r.name for r in RULES))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and ``failed``: one bit per failed rule."""
    rows = docs.select("doc_id", measured()("text").alias("m")).select("doc_id", "m.*")
    bits = [F.when(F.expr(r.fails), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
            for i, r in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return rows.withColumn("failed", failed)


def passes(policy: Policy, failed: Column | str = "failed") -> Column:
    """Whether no rule of the policy failed."""
    column = F.col(failed) if isinstance(failed, str) else failed
    return column.bitwiseAND(F.lit(policy.mask()).cast("bigint")) == 0


def judge(docs: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """One row per row of ``docs``: the measurements, ``base_failed``, ``kept`` and ``failed``."""
    return ledger(docs).select(
        "doc_id", *MEASURES[:-1], (~passes(BASE)).alias("base_failed"),
        (passes(BASE) & passes(policy)).alias("kept"), "failed")


def ablation(rows: DataFrame, policies: tuple[Policy, ...]) -> DataFrame:
    """For each policy and rule of it: documents kept, that fail the rule, that only it rejects,
    and that would be kept without it.

    The rows are first counted by their bits, so the work after that doesn't grow with the corpus:
    a policy of r rules sees 2 ** r combinations at most.
    """
    states = rows.groupBy("failed").agg(F.count("*").alias("n"))
    asked = [(p.name, p.version, p.mask(), r.name, 1 << i) for p in policies
             for i, r in enumerate(RULES) if p.mask() >> i & 1]
    question = F.array(*[F.struct(
        F.lit(name).alias("policy"), F.lit(version).alias("version"), F.lit(mask).cast("bigint").alias("mask"),
        F.lit(rule).alias("rule"), F.lit(bit).cast("bigint").alias("bit")) for name, version, mask, rule, bit in asked])
    seen = F.col("failed").bitwiseAND(F.col("mask"))

    def total(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias(name)

    counts = (states.select("failed", "n", F.inline(question)).groupBy("policy", "version", "rule")
              .agg(total(seen == 0, "kept"), total(seen.bitwiseAND(F.col("bit")) != 0, "failing"),
                   total(seen == F.col("bit"), "only_this_rule"),
                   total(seen.bitwiseAND(F.bitwise_not("bit")) == 0, "kept_without")))
    every = rows.sparkSession.range(1).select(F.inline(question)).select("policy", "version", "rule")
    return every.join(counts, ["policy", "version", "rule"], "left").fillna(0)
