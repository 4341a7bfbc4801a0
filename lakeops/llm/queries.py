"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.byte_bpe import encode_documents
from lakeops.llm.common import table
from lakeops.llm.infilling import rearrange, restored
from lakeops.llm.langid import identify_language
from lakeops.llm.lexicon_bpe import encode_texts
from lakeops.llm.licenses import scan_licenses
from lakeops.llm.merkle import compare_with_next
from lakeops.llm.packing import pack
from lakeops.llm.pii import personal_data_report
from lakeops.llm.quality_gam import classify_quality
from lakeops.llm.rules import RULES, STRICT, BASE, judge
from lakeops.llm.simhash import near_copies
from lakeops.llm.urls import filter_urls, rules_of
from lakeops.llm.vector_codes import compress

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same question for DuckDB."""
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build
    return add


@query("op1_pii")
def _(spark, sf):
    return personal_data_report(table(spark, sf, "documents"), scope="document")


@query("op2_quality")
def _(spark, sf):
    return classify_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op3_byte_bpe")
def _(spark, sf):
    return encode_documents(table(spark, sf, "documents"),
                            public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op4_packing")
def _(spark, sf):
    return pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op5_licenses")
def _(spark, sf):
    return scan_licenses(table(spark, sf, "documents")).drop("notices")


@query("op6_rules", sql=f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t,
                          regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
                FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM texts)),
    again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
    covered AS (SELECT doc_id, count(DISTINCT p) AS n
                FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
    lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup
              FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM texts)
              WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
    measured AS (
        SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
               length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
               coalesce(lines.dup, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
               coalesce(lines.n, 0) AS n_lines
        FROM texts LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
    ledger AS (SELECT *, {" + ".join(f"CASE WHEN {r.fails} THEN {1 << i} ELSE 0 END"
                                     for i, r in enumerate(RULES))} AS failed FROM measured)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           (failed & {BASE.mask()}) <> 0 AS base_failed,
           (failed & {BASE.mask() | STRICT.mask()}) = 0 AS kept, CAST(failed AS BIGINT) AS failed
    FROM ledger""")
def _(spark, sf):
    return judge(table(spark, sf, "documents"))


# The rules of the contract, as (action, host and path).
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


@query("op7_urls", sql=f"""
    WITH rules(action, rule) AS (VALUES {", ".join(map(str, URL_RULES))}),
    cut AS (SELECT action, rule, split_part(rule, '/', 1) AS rule_host,
                   substr(rule, strpos(rule, '/')) AS rule_path FROM rules),
    parts AS (SELECT page_id, translate(regexp_extract(u, '^([^/?#]*)', 1),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(u, '^[^/?#]*([^?#]*)', 1) AS path
              FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0
                                         THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS u FROM pages)),
    fits AS (SELECT page_id, rule, action FROM parts JOIN cut
             ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
             QUALIFY row_number() OVER (PARTITION BY page_id
                                        ORDER BY length(rule) DESC, length(rule_host) DESC, rule) = 1)
    SELECT page_id, host, path, rule,
           coalesce(action, CASE WHEN host <> '' THEN 'allow' ELSE 'block' END) AS verdict
    FROM parts LEFT JOIN fits USING (page_id)""")
def _(spark, sf):
    return filter_urls(table(spark, sf, "pages"), rules_of(spark, URL_RULES))


@query("op8_simhash")
def _(spark, sf):
    return near_copies(table(spark, sf, "documents"))


@query("op9_language")
def _(spark, sf):
    return identify_language(table(spark, sf, "documents"))


@query("op10_merkle")
def _(spark, sf):
    return compare_with_next(table(spark, sf, "documents"))


def _codebook_rounds(rounds: int = 4) -> str:
    """Common table expressions: book0 are the start entries, book<r> those after r rounds."""
    out = []
    for r in range(rounds + 1):
        out.append(f"""near{r} AS MATERIALIZED (
        SELECT vec_id, position, arg_min(entry, (far, entry)) AS entry, min(far) AS far
        FROM (SELECT vec_id, p.position, entry, list_sum(list_transform(list_zip(part, mean),
                         lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS far
              FROM parts p JOIN book{r} USING (position)) GROUP BY vec_id, position)""")
        if r < rounds:
            out.append(f"""book{r + 1} AS MATERIALIZED (
        SELECT position, entry, coalesce(moved, b.mean) AS mean FROM book{r} b LEFT JOIN (
            SELECT position, entry, list(CAST(floor(total / n) AS BIGINT) ORDER BY i) AS moved
            FROM (SELECT position, entry, i, sum(part[i]) AS total, count(*) AS n
                  FROM near{r} JOIN parts USING (vec_id, position), unnest(generate_series(1, len(part))) g(i)
                  GROUP BY position, entry, i) GROUP BY position, entry) USING (position, entry))""")
    return ",\n    ".join(out)


@query("op11_vector_codes", sql=f"""
    WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
        SELECT vec_id, position, v[position * (len(v) // 4) + 1:(position + 1) * (len(v) // 4)] AS part
        FROM kept, unnest(generate_series(0, 3)) g(position)),
    book0 AS MATERIALIZED (
        SELECT position, row_number() OVER (PARTITION BY position ORDER BY vec_id) - 1 AS entry, part AS mean
        FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)),
    {_codebook_rounds()},
    coded AS (SELECT vec_id, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY position) AS code,
                     CAST(sum(far) AS BIGINT) AS error FROM near4 GROUP BY vec_id),
    written AS (SELECT sha256(string_agg(array_to_string(mean, ','), ',' ORDER BY position, entry)) AS digest FROM book4)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           digest AS codebooks_sha256
    FROM coded JOIN kept USING (vec_id), written""")
def _(spark, sf):
    return compress(table(spark, sf, "embeddings"))


@query("op12_infilling", sql="""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t,
                          regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                          sha256('1:' || doc_id) AS h FROM documents),
    drawn AS (SELECT doc_id, t, units, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
                     CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
                     CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM texts),
    formed AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                                   OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
                      least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM drawn),
    cut AS (SELECT doc_id, n, form, t, array_to_string(units[1:a], '') AS prefix,
                   array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix FROM formed)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM cut""")
def _(spark, sf):
    return rearrange(table(spark, sf, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query("op13_lexicon_bpe")
def _(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return encode_texts(table(spark, sf, "documents"), path, back=True).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
