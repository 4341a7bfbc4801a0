"""Personal data: direct identifiers by their form, and terms that give them away.

Direct identifiers (e-mail, IP, card and phone numbers) are protected entities. A term near an
entity gives it away as far as seeing the term makes the entity less surprising. With
``P(c)`` the share of the corpus' words that stand near entity ``c`` and ``P(c|t)`` that share among
the occurrences of term ``t``, the pointwise mutual information ``log2 P(c|t)/P(c)`` is the part of
the entity's information ``-log2 P(c)`` that the term discloses: 0 for an unrelated term, 1 for one
that never occurs elsewhere. Terms that disclose ``generalise_at`` of it, seen in ``min_contexts``
different contexts of the entity at least (copies of one context are one), are generalised near
that entity; from ``remove_at`` they are removed. All counts cover the whole corpus.

With ``scope="document"`` (what the query and the pipeline use) a context is a distinct document: all
words of a document stand with all its entities, wherever they are, and a disclosing term is
masked wherever it occurs in the documents that hold its entity. Two things are asked of it:

- It leaves little surprise about the entity, ``-log2 P(c|t)`` bits, with ``P(c|t)`` drawn towards ``P(c)``, the share of
  documents with the entity, by ``SHRINK`` of an observation: ``generalise_at`` and ``remove_at`` are thresholds
  on ``P(c|t)``, the same at every number of documents.
- It doesn't only look so because it is rare. A word that occurs once stands in one document, and if that
  holds an entity, nowhere else; so do most words of a large corpus. That ``b`` of a term's ``n`` documents are the
  entity's is worth ``b log2 1/P(c)`` bits less ``n H(b/n)`` for which of them, less ``log2 M`` for the choice
  among the ``M`` terms as frequent as this one; what is left must be ``EVIDENCE`` bits, i.e. chance gives an
  entity less than one such term in twenty. Words that occur once fail this where there are many of them.

Everything here is DataFrame expressions. Offsets are code points, ends exclusive.

Defined results: a null text is empty and has no spans. Repeated rows get equal results. Entities
of different kinds may overlap, and a term may lie inside one; the sanitised text merges what
overlaps and names the kind that begins first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import row_key, running_starts
from lakeops.session import settle

SCOPES = ("near", "document")

# The order of kinds, and what the forms of direct identifiers match. The look-behinds
# and possessive quantifiers only spare the matcher work: a match never begins inside a run
# of characters that could have begun it, unless the match before ended there.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]",
         "removed": ""}
WORD = r"\p{L}{3,}"
SHRINK = 0.25    # observations of the corpus' share that a term's share of an entity is drawn towards
EVIDENCE = 4.4   # bits: log2 of one in twenty


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether up to 19 digits have a right check digit."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _is_valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.when(
            F.length(F.regexp_replace(p, "^0+", "")) <= 3,
            F.concat(F.lit("0"), F.right(p, F.lit(3))).cast("int") <= 255).otherwise(False))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    """Names the protected value, however it is written."""
    plain = _digits(value) if kind in ("card", "phone") else F.lower(value)
    return F.xxhash64(F.lit(kind), plain)


def find_entities(docs: DataFrame, reach: int = 48, with_text: bool = False) -> DataFrame:
    """doc_id, key, and ``base``: every direct identifier of the whole text, in order, with its
    entity and the text up to ``reach`` code points before and after it; ``text`` too, of rows that
    have one, if asked for."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"),
                       text.alias("text"))
    none, whole = F.array().cast("array<string>"), F.col("text")
    split = rows.select("doc_id", "key", *["text"] * with_text, *[
        F.when(whole.rlike(NEEDS[k]), c).otherwise(none).alias(f"{name}_{k}")
        for k in KINDS for name, c in (
            ("hit", F.regexp_extract_all(whole, F.lit(PATTERNS[k]), F.lit(0))),
            ("gap", F.split(whole, PATTERNS[k], -1)))])
    # Text beside a hit, over the hits before and after it. Every hit has two characters at least, so
    # so many neighbours fill the reach; long pieces count with the end that can be within it.
    side, neighbours = F.lit(reach + 1), reach // 2 + 1
    # (One column for both sides: used twice, it is computed once per row and not once per hit.)
    placed = split.select("*", *[
        F.transform(F.arrays_zip(F.col(f"hit_{k}").alias("v"),
                                 F.slice(f"gap_{k}", F.lit(1), F.size(f"hit_{k}")).alias("l"),
                                 F.slice(f"gap_{k}", F.lit(2), F.size(f"hit_{k}")).alias("r")),
                    lambda x: F.struct(F.right(F.concat(x["l"], x["v"]), side).alias("left"),
                                       F.left(F.concat(x["v"], x["r"]), side).alias("right"))).alias(f"beside_{k}")
        for k in KINDS], *[
        running_starts(F.zip_with(f"hit_{k}", F.slice(f"gap_{k}", F.lit(1), F.size(f"hit_{k}")),
                                  lambda hit, gap: F.length(hit) + F.length(gap))).alias(f"at_{k}")
        for k in KINDS])

    def spans(i: int, k: str) -> Column:
        hit, gap = F.col(f"hit_{k}"), F.col(f"gap_{k}")
        parts = F.arrays_zip(hit.alias("v"), F.slice(gap, F.lit(1), F.size(hit)).alias("l"),
                             F.slice(gap, F.lit(2), F.size(hit)).alias("r"), F.col(f"at_{k}").alias("at"),
                             F.when(F.size(hit) > 0, F.sequence(F.lit(1), F.size(hit)))
                             .otherwise(F.array().cast("array<int>")).alias("n"))
        valid = F.filter(parts, lambda x: _is_valid(k, x["v"]))

        def before(x: Column) -> Column:
            first = F.greatest(F.lit(1), x["n"] - neighbours)
            return F.right(F.concat(F.array_join(F.slice(F.col(f"beside_{k}"), first, x["n"] - first)["left"], ""),
                                    F.right(x["l"], side)), side)

        def after(x: Column) -> Column:
            return F.left(F.concat(F.left(x["r"], side), F.array_join(
                F.slice(F.col(f"beside_{k}"), x["n"] + 1, F.lit(neighbours))["right"], "")), side)

        return F.transform(valid, lambda x: F.struct(
            (x["at"] + F.length(x["l"])).alias("start"), F.lit(i).alias("rank"),
            (x["at"] + F.length(x["l"]) + F.length(x["v"])).alias("end"), F.lit(k).alias("kind"),
            _entity(k, x["v"]).alias("entity"),
            before(x).alias("before"), after(x).alias("after")))

    found = F.array_sort(F.concat(*[spans(i, k) for i, k in enumerate(KINDS)]))
    out = placed.select("doc_id", "key", found.alias("base"), *["text"] * with_text)
    return out.withColumn("text", F.when(F.size("base") > 0, F.col("text"))) if with_text else out


def nearby_terms(found: DataFrame, reach: int) -> DataFrame:
    """One row per word near an entity: key, entity, term (hash), context (hash), start, end.

    A word that touches the far edge of the reach may be cut there and is left out."""
    near = found.select("key", F.explode("base").alias("b"))
    cut = F.col("b.before"), F.col("b.after")
    before = F.when(F.length(cut[0]) > reach, F.regexp_replace(cut[0], r"^\p{L}+", "")).otherwise(cut[0])
    after = F.when(F.length(cut[1]) > reach, F.regexp_replace(cut[1], r"\p{L}+$", "")).otherwise(cut[1])
    sides = near.select("key", F.col("b.entity").alias("entity"),
                        F.xxhash64(F.lower(cut[0]), F.lower(cut[1])).alias("context"),
                        F.explode(F.array(
                            F.struct((F.col("b.start") - F.length(before)).alias("at"), before.alias("side")),
                            F.struct(F.col("b.end").alias("at"), after.alias("side")))).alias("s"))
    words = sides.select("key", "entity", "context", F.col("s.at").alias("at"),
                         F.regexp_extract_all("s.side", F.lit(WORD), F.lit(0)).alias("word"),
                         F.split("s.side", WORD, -1).alias("gap"))
    first = F.slice("gap", F.lit(1), F.size("word"))
    placed = words.select("key", "entity", "context", "at", F.explode(F.arrays_zip(
        F.col("word").alias("word"), F.transform(first, F.length).alias("gap"),
        running_starts(F.zip_with("word", first, lambda w, g: F.length(w) + F.length(g))).alias("s"))).alias("w"))
    start = F.col("at") + F.col("w.s") + F.col("w.gap")
    return placed.select("key", "entity", "context", F.xxhash64(F.lower("w.word")).alias("term"),
                         start.alias("start"), (start + F.length("w.word")).alias("end"))


def disclosing_terms(docs: DataFrame, near: DataFrame, min_contexts: int = 3,
                     generalise_at: float = 0.7) -> DataFrame:
    """(entity, term, disclosed) of the terms that disclose enough of an entity near them."""
    counts = settle(
        docs.select(F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("word"))
        .groupBy(F.xxhash64(F.lower("word")).alias("term")).agg(F.count("*").alias("n_term")), "terms")
    total = counts.agg(F.sum("n_term")).first()[0] or 1
    joint = (near.groupBy("entity", "term", "context").agg(F.count("*").alias("n"))
             .groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("n_contexts")))
    around = near.groupBy("entity").agg(F.count("*").alias("n_entity"))
    measured = (joint.filter(F.col("n_contexts") >= min_contexts)
                .join(around, "entity").join(counts, "term"))
    # A word can stand near two places of one entity, and count twice.
    given = F.least(F.lit(1.0), F.col("n_both") / F.col("n_term"))
    prior = F.least(F.lit(0.5), F.col("n_entity") / F.lit(float(total)))
    disclosed = F.log2(given / prior) / -F.log2(prior)
    return (measured.select("entity", "term", disclosed.alias("disclosed"))
            .filter(F.col("disclosed") >= generalise_at))


def _terms_of(text: Column) -> Column:
    """Hashes of the distinct words."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)),
                                        lambda w: F.xxhash64(w)))


def count_documents(docs: DataFrame) -> tuple[DataFrame, int]:
    """(term, n_term): in how many distinct texts each word is; and the number of distinct texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.xxhash64(text).alias("h"), F.length(text).alias("n"), text.alias("text"))
    # The words of a text travel once by its hash; copies in one map task are merged before.
    terms = (rows.select("h", "n", _terms_of(F.col("text")).alias("terms"))
             .groupBy("h", "n").agg(F.first("terms").alias("terms")))
    counts = terms.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    return settle(counts, "terms"), rows.select("h", "n").distinct().count()


def _held_terms(found: DataFrame, *keep: Column) -> DataFrame:
    """The columns ``keep``, entity and term of every word and entity of the rows that hold one."""
    return (found.filter(F.size("base") > 0)
            .select(*keep, F.explode(F.array_distinct("base.entity")).alias("entity"), _terms_of(F.col("text")).alias("terms"))
            .select(*[F.col(c) for c in ("key",) if keep], "entity", F.explode("terms").alias("term")))


def disclosing_in_documents(docs: DataFrame, found: DataFrame, generalise_at: float = 0.7) -> DataFrame:
    """(entity, term, disclosed) of the terms that disclose enough of an entity in its documents."""
    counts, total = count_documents(docs)
    once = found.filter(F.size("base") > 0).groupBy("key.h", "key.n").agg(
        F.first("base").alias("base"), F.first("text").alias("text"))
    joint = _held_terms(once).groupBy("entity", "term").agg(F.count("*").alias("n_both"))
    around = (once.select(F.explode(F.array_distinct("base.entity")).alias("entity"))
              .groupBy("entity").agg(F.count("*").alias("n_entity")))
    # Frequencies in bins of a quarter of a power of two: a few hundred at most.
    bin_of = F.floor(F.log2("n_term") * 4)
    same = counts.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n_same"))
    prior = F.least(F.lit(0.5), F.col("n_entity") / F.lit(float(max(total, 1))))
    share = F.col("n_both") / F.col("n_term")
    spread = F.when(share < 1, -(share * F.log2(share) + (1 - share) * F.log2(1 - share))).otherwise(0.0)
    evidence = -F.col("n_both") * F.log2(prior) - F.col("n_term") * spread - F.log2("n_same")
    disclosed = (F.col("n_both") + SHRINK * prior) / (F.col("n_term") + SHRINK)
    return (joint.join(counts, "term").filter(F.col("n_both") / F.col("n_term") >= generalise_at)
            .join(around, "entity").withColumn("bin", bin_of).join(F.broadcast(same), "bin")
            .filter(evidence >= EVIDENCE)
            .select("entity", "term", disclosed.alias("disclosed")).filter(F.col("disclosed") >= generalise_at))


def terms_in_documents(found: DataFrame, telling: DataFrame) -> DataFrame:
    """(key, start, end, disclosed) of every occurrence of a term in the rows that hold its entity."""
    held = found.filter(F.size("base") > 0)
    # A row's own words are looked up, so an entity in many documents doesn't bring all its terms to each.
    told = (_held_terms(found, F.col("key")).join(telling, ["entity", "term"])
            .groupBy("key", "term").agg(F.max("disclosed").alias("disclosed")))
    words = held.select("key", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("word"),
                        F.split("text", WORD, -1).alias("gap"))
    first = F.slice("gap", F.lit(1), F.size("word"))
    placed = words.select("key", F.explode(F.arrays_zip(
        F.col("word").alias("word"), F.transform(first, F.length).alias("gap"),
        running_starts(F.zip_with("word", first, lambda w, g: F.length(w) + F.length(g))).alias("s"))).alias("w"))
    start = F.col("w.s") + F.col("w.gap")
    return (placed.select("key", F.xxhash64(F.lower("w.word")).alias("term"), start.alias("start"),
                          (start + F.length("w.word")).alias("end"))
            .join(told, ["key", "term"]).select("key", "start", "end", "disclosed"))


def find_personal_data(docs: DataFrame, reach: int = 48, min_contexts: int = 3,
                       generalise_at: float = 0.7, remove_at: float = 0.95, scope: str = "near") -> DataFrame:
    """One row per row of ``docs``: doc_id, key, ``base`` spans and ``terms`` spans, in order.

    ``reach`` and ``min_contexts`` are of the scope ``near`` only."""
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    if scope == "document":
        found = settle(find_entities(docs, 0, with_text=True), "entities")
        telling = settle(disclosing_in_documents(docs, found, generalise_at), "telling")
        spans = terms_in_documents(found, telling)
    else:
        found = settle(find_entities(docs, reach), "entities")
        near = nearby_terms(found, reach)
        spans = near.join(disclosing_terms(docs, near, min_contexts, generalise_at), ["entity", "term"])
    kind = F.when(F.col("disclosed") >= remove_at, "removed").otherwise("term")
    terms = (spans.groupBy("key", "start", "end").agg(F.max("disclosed").alias("disclosed"))
             .groupBy("key").agg(F.array_sort(F.collect_list(F.struct(
                 "start", F.lit(len(KINDS)).alias("rank"), F.col("end"), kind.alias("kind")))).alias("terms")))
    plain = F.transform("base", lambda s: F.struct(*[
        s[name].alias(name) for name in ("start", "rank", "end", "kind")]))
    return (found.select("doc_id", "key", plain.alias("base")).join(terms, "key", "left")
            .select("doc_id", "key", "base", F.coalesce(
                "terms", F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")).alias("terms")))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data_report(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, counts by kind, the digest of the base spans, all spans as text, and how many they are."""
    rows = find_personal_data(docs, **settings)

    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    return rows.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("base", "terms"))).alias("spans"),
        F.size("terms").cast("long").alias("n_terms"), (F.size("base") + F.size("terms")).cast("long").alias("n_spans"))


def sanitise(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with every span generalised or removed; ``n_chars``, if there, follows the text."""
    spans = (find_personal_data(docs, **settings)
             .select(F.col("key").alias("_llm_key"), F.array_sort(F.concat("base", "terms")).alias("_llm_spans"))
             .filter(F.size("_llm_spans") > 0).dropDuplicates(["_llm_key"]))
    nothing = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("from"),
                       F.array().cast("array<struct<from:bigint,to:bigint,kind:string>>").alias("out"))

    def place(acc: Column, s: Column) -> Column:
        """Adds the kept text before a span and its mask; a span inside the last one adds nothing."""
        apart = s["start"] >= acc["end"]
        return F.struct(
            F.greatest(acc["end"], s["end"]).alias("end"), acc["from"].alias("from"),
            F.when(apart, F.concat(acc["out"], F.array(F.struct(
                acc["end"].alias("from"), s["start"].alias("to"), s["kind"].alias("kind")))))
            .when(s["end"] > acc["end"], F.concat(acc["out"], F.array(F.struct(
                s["start"].alias("from"), s["start"].alias("to"), F.lit("removed").alias("kind")))))
            .otherwise(acc["out"]).alias("out"))

    joined = (docs.withColumn("_llm_own", row_key(F.col("doc_id"), F.col("text")))
              .join(spans, F.col("_llm_own") == F.col("_llm_key"), "left"))
    laid = joined.withColumn("_llm_laid", F.when(
        F.col("_llm_spans").isNotNull(), F.aggregate("_llm_spans", nothing, place)))
    masks = F.create_map(*[F.lit(x) for pair in MASKS.items() for x in pair])
    pieces = F.transform("_llm_laid.out", lambda p: F.concat(
        F.substring(F.col("text"), (p["from"] + 1).cast("int"), (p["to"] - p["from"]).cast("int")),
        F.element_at(masks, p["kind"])))
    tail = F.substring(F.col("text"), (F.col("_llm_laid.end") + 1).cast("int"), F.length("text"))
    clean = F.when(F.col("_llm_laid").isNull(), F.col("text")).otherwise(F.concat(F.array_join(pieces, ""), tail))
    out = laid.withColumn("text", clean)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("_llm_laid").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(kind)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
