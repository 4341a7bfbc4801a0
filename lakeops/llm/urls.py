"""URL filter as a sort-merge range join.

A host is written with its labels reversed, each closed by a dot (``www.example.org`` becomes
``org.example.www.``). All hosts below a rule's host then begin with the rule's key: the rule is an
interval of keys, and intervals either nest or lie apart. Urls and the ends of intervals
are sorted together and swept. The beginning of an interval carries the stack of rules that are active
from there on (its own and those it is nested in), the end carries the stack below it; a url's
active rules are those of the last end before it. Among them, the longest whose path begins the
url's path decides.

The sweep runs in ranges of keys, each opened by the stack at its first key. Range borders come from a
bounded sample of the urls and carry a hash of the page, so a host with a third of all pages
spreads over many ranges. They change how work is spread, never a result.

Everything is DataFrame expressions. Defined results: a null url or one without ``://`` has empty
host and path. Without a fitting rule, urls with a host are allowed and the others blocked.
``rule`` and its length are compared as written; equal lengths go to the longer host, then to the
alphabetically first. Repeated rows each get the same result. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.llm.common import hash_sample, lower_ascii, range_of

ROWS_PER_RANGE = 1 << 20
RULE = "struct<size:int,host_size:int,rule:string,path:string,action:string>"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both empty where there is no ``://``."""
    shape = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(whole, shape, 1)), F.regexp_extract(whole, shape, 2)


def host_key(host: Column) -> Column:
    """Reversed labels, each with a dot, in hexadecimal: the order of bytes as order of text."""
    return F.hex(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): for each host with rules, the rules active at it, nested ones included.

    ``rules`` has action and rule (``host/path``)."""
    cut = F.instr("rule", "/")
    parts = (rules.filter(cut > 0).select(
        "action", "rule", F.expr("substring(rule, 1, instr(rule, '/') - 1)").alias("host"),
        F.expr("substring(rule, instr(rule, '/'))").alias("path")).distinct())
    own = parts.groupBy("host").agg(F.collect_list(F.struct(
        F.length("rule").alias("size"), F.length("host").alias("host_size"), "rule", "path", "action")
        .cast(RULE)).alias("own"))
    # The hosts that one is nested in are its own endings.
    labels = F.split("host", r"\.", -1)
    above = own.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("ending"))
    held = own.select(F.col("host").alias("ending"), "own")
    return (above.join(held, "ending").groupBy("host")
            .agg(F.flatten(F.collect_list("own")).alias("stack"))
            .select(host_key(F.col("host")).alias("key"), "stack"))


def _endings(key: Column) -> Column:
    """The keys that a key (hexadecimal, closed by a dot) begins with, label by label."""
    labels = F.split(F.unhex(key).cast("string"), r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels) - 1),
                       lambda i: F.hex(F.concat(F.array_join(F.slice(labels, F.lit(1), i), "."), F.lit("."))))


def borders(keyed: DataFrame, ranges: int, per_range: int = 16) -> list[str]:
    """Keys that cut the table into about even ranges, from ``ranges * per_range`` rows at most."""
    if ranges < 2:
        return []
    drawn = hash_sample(keyed.select("at"), ranges * per_range, "at").collect()
    sample = sorted(r["at"] for r in drawn)
    return sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []


def sweep(keyed: DataFrame, stacks: DataFrame, ranges: int) -> DataFrame:
    """``keyed`` (page_id, host, path, key, at) with the stack of rules active at each row."""
    spark = keyed.sparkSession
    cuts = borders(keyed, ranges)
    none = F.array().cast(f"array<{RULE}>")
    parents = (stacks.select("key", F.explode(_endings(F.col("key"))).alias("upper"))
               .filter("upper != key")
               .join(stacks.select(F.col("key").alias("upper"), F.col("stack").alias("below")), "upper")
               .groupBy("key").agg(F.max_by("below", F.length("upper")).alias("below")))
    ends = stacks.join(parents, "key", "left")
    begin = ends.select(F.col("key").alias("at"), "stack")
    close = ends.select(F.concat("key", F.lit("FF")).alias("at"), F.coalesce("below", none).alias("stack"))
    # The stack at a border is that of the innermost rule host its key begins with.
    starts = F.split(F.lit(",".join(["", *cuts])), ",")
    opened = spark.range(len(cuts) + 1).select(
        F.col("id").cast("int").alias("part"), F.element_at(starts, (F.col("id") + 1).cast("int")).alias("at"))
    reached = (opened.filter("at != ''")
               .select("part", F.explode(_endings(F.expr("left(at, length(at) - 18)"))).alias("key"))
               .join(stacks, "key").groupBy("part").agg(F.max_by("stack", F.length("key")).alias("stack")))
    opening = opened.join(reached, "part", "left").select("part", "at", F.coalesce("stack", none).alias("stack"))

    def events(df: DataFrame, kind: int, part: Column) -> DataFrame:
        return df.select(part.cast("int").alias("part"), "at", F.lit(kind).alias("kind"), "stack",
                         *[F.lit(None).cast(t).alias(c) for c, t in columns])

    columns = [(c, t) for c, t in keyed.dtypes if c in ("page_id", "host", "path")]
    rows = keyed.select(range_of(F.col("at"), cuts, "string").cast("int").alias("part"), "at", F.lit(2).alias("kind"),
                        F.lit(None).cast(f"array<{RULE}>").alias("stack"), *[c for c, _ in columns])
    together = (events(opening, 0, F.col("part"))
                .unionByName(events(begin.union(close), 1, range_of(F.col("at"), cuts, "string")))
                .unionByName(rows))
    order = Window.partitionBy("part").orderBy("at", "kind")
    return (together.withColumn("active", F.last("stack", ignorenulls=True).over(order))
            .filter("kind = 2"))


def filter_urls(pages: DataFrame, rules: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict."""
    spark = pages.sparkSession
    if ranges is None:
        ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pages.count() // ROWS_PER_RANGE))
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", F.col("url"), host.alias("host"), path.alias("path"))
    keyed = parts.select("page_id", "host", "path", F.concat(
        host_key(F.col("host")), F.lit("00"),
        F.lpad(F.hex(F.xxhash64("page_id", "url")), 16, "0")).alias("at"))
    swept = sweep(keyed, rule_stacks(rules), ranges)
    # "size" leads the struct, then the host's; a smaller rule text wins a tie of both.
    fitting = F.array_sort(
        F.filter("active", lambda r: F.startswith(F.col("path"), r["path"])),
        lambda a, b: F.when(a["size"] != b["size"], b["size"] - a["size"])
        .when(a["host_size"] != b["host_size"], b["host_size"] - a["host_size"])
        .when(a["rule"] < b["rule"], -1).when(a["rule"] > b["rule"], 1).otherwise(0))
    best = F.get(fitting, F.lit(0))
    return (swept.select("page_id", "host", "path", best.alias("best"))
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.action", F.when(F.col("host") != "", "allow").otherwise("block")).alias("verdict")))


def rules_of(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """A short list of (action, ``host/path``) as a table."""
    one = spark.range(1)
    if not rules:
        return one.select(F.lit("").alias("action"), F.lit("").alias("rule")).where(F.lit(False))
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(action).alias("action"), F.lit(rule).alias("rule")) for action, rule in rules])))
