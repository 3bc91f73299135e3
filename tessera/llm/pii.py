"""Personal data by patterns, and information-theoretic sanitisation of the
words that give it away. DataFrame functions only.

Base spans are e-mail addresses, IP addresses, card and phone numbers. A
value that occurs in documents is a protected entity ``c``, and so are the
units that it belongs to (the domain and its parent, the networks, the number
prefixes, the issuer), through which values that are rare themselves are
judged. A term ``t`` (a lower-cased run of letters) beside it discloses it by
the pointwise mutual information ``PMI(t; c) = log2(N * docs(t, c) / (docs(t) *
docs(c)))``, at most the information content ``IC(c) = log2(N / docs(c))``, which
is reached when the term never stands without the value. Few texts prove
little: the PMI is discounted by ``n / (n + 1/4)`` for the number ``n`` of
different texts with both, and again for the lesser number of the two alone.
Where it still is ``alpha * IC``, the term is a span of kind ``term`` in every
document with the entity. Counts are over all documents. ``sanitised``
generalises base spans to their kind and removes terms.

Spans are found once and stored with the documents. An entity in so few texts
that even a term that never stands without it falls short of ``alpha`` by the
discount can't be disclosed, and no pair is made of it; pairs are
pre-aggregated before they are shuffled. A text's terms are matched on
(entity, term), so only those that it holds meet.

Defined results: a null text is empty; equal texts get equal spans; a null id
is kept; an empty table gives an empty result; other columns are ignored, or
passed through by ``sanitised``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh_names, joined_by_comma, require, stored

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
ALPHA = 0.8
DOUBT = 0.25  # texts added below the line of a discount
TERM_LETTERS = 2  # a letter alone names nobody

# Possessive forms of the base patterns with the same matches: where a part
# can only end at a character outside of it, giving back never helps. A
# match starts after a character that can't be part of it, or where the last
# one ended. The card pattern takes runs of 14 to 19 digits whole.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NOT_LETTERS = r"[^\p{L}]+"
BLOCK = 256  # of lengths summed together


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    """Whether a number of at most 19 digits passes Luhn's check."""
    digits = F.lpad(_digits(m), 19, "0")
    doubled = F.translate(digits, "0123456789", "0246813579")
    place = lambda i: F.substr(F.when(i % 2 == 0, doubled).otherwise(digits), i, F.lit(1)).cast("int")
    return F.aggregate(F.sequence(F.lit(1), F.lit(19)), F.lit(0), lambda s, i: s + place(i)) % 10 == 0


def _part_fits(p: Column) -> Column:
    short = F.regexp_replace(p, "^0+", "")
    return (F.length(short) < 3) | ((F.length(short) == 3) & (short <= "255"))


VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), _part_fits),
    "card": _luhn,
    "phone": lambda m: F.length(_digits(m)).between(10, 15),
}


def _running(lengths: Column) -> Column:
    """Sums of the elements before each one. Blocks are summed apart, so the
    arrays that grow by one are short."""
    def sums(x: Column) -> Column:
        return F.aggregate(x, F.array(F.lit(0)).cast("array<int>"), lambda a, v: F.concat(a, F.array(F.element_at(a, -1) + v)))

    n = F.size(lengths)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / F.lit(BLOCK)).cast("int")),
        lambda b: sums(F.slice(lengths, b * F.lit(BLOCK) + 1, F.lit(BLOCK))),
    )
    starts = sums(F.transform(blocks, lambda p: F.element_at(p, -1)))
    return F.flatten(F.transform(
        F.arrays_zip(blocks.alias("p"), F.slice(starts, F.lit(1), F.size(blocks)).alias("s")),
        lambda x: F.transform(F.slice(x["p"], F.lit(1), F.size(x["p"]) - 1), lambda v: v + x["s"]),
    ))


def _places(text: Column, pattern: str) -> Column:
    """Structs of the matches of a pattern: start, end, match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    before = F.slice(gaps, F.lit(1), F.size(found))
    starts = _running(F.zip_with(before, found, lambda g, m: F.length(g) + F.length(m)))
    joined = F.arrays_zip(starts.alias("before"), before.alias("gap"), found.alias("match"))
    placed = F.transform(joined, lambda x: F.struct(
        (x["before"] + F.length(x["gap"])).alias("start"),
        (x["before"] + F.length(x["gap"]) + F.length(x["match"])).alias("end"),
        x["match"].alias("match"),
    ))
    return F.when(F.size(found) > 0, placed)


SPAN = "array<struct<start:int,rank:int,end:int,kind:string,match:string>>"


def _spans_of(text: Column, kind: str) -> Column:
    guard = {"email": text.contains("@"), "phone": text.contains("+")}.get(kind, text.rlike(PATTERNS[kind]))
    valid = F.filter(_places(text, PATTERNS[kind]), lambda x: VALID[kind](x["match"]))
    shaped = F.transform(valid, lambda x: F.struct(
        x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"),
        F.lit(kind).alias("kind"), x["match"].alias("match"),
    )).cast(SPAN)
    return F.coalesce(F.when(guard, shaped), F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Spans of the four kinds by start, then kind."""
    return F.array_sort(F.concat(*[_spans_of(text, k) for k in KINDS]))


def _values(spans: Column) -> Column:
    """Protected entities: kind and match; phone and card numbers by their
    digits."""
    return F.array_distinct(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], F.when(s["kind"].isin("card", "phone"), _digits(s["match"])).otherwise(F.lower(s["match"])),
    )))


def _units(spans: Column) -> Column:
    """Protected entities: the values and the units that they belong to."""
    def of(s: Column) -> Column:
        digits, low = _digits(s["match"]), F.lower(s["match"])
        domain = F.substring_index(low, "@", -1)
        units = F.when(s["kind"] == "email", F.array(F.concat(F.lit("domain:"), domain), F.concat(F.lit("domain:"), F.substring_index(domain, ".", -2))))
        units = units.when(s["kind"] == "ip", F.array(*[F.concat(F.lit("network:"), F.substring_index(low, ".", n)) for n in (3, 2)]))
        units = units.when(s["kind"] == "card", F.array(F.concat(F.lit("issuer:"), F.substring(digits, 1, 6))))
        return units.otherwise(F.array(*[F.concat(F.lit("prefix:"), F.substring(digits, 1, n)) for n in (7, 4)]))

    return F.array_distinct(F.concat(_values(spans), F.flatten(F.transform(spans, of))))


def _terms(text: Column) -> Column:
    words = F.split(F.lower(text), NOT_LETTERS)
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= TERM_LETTERS))


def _discount(n: Column) -> Column:
    return n / (n + F.lit(DOUBT))


def least_texts(alpha: float) -> int:
    """The fewest texts in which a term can disclose an entity."""
    n = 1
    while (n / (n + DOUBT)) ** 2 < alpha:
        n += 1
    return n


def spanned(docs: DataFrame, text_col: str, key: str, base: str) -> DataFrame:
    """``docs`` with a digest of the text and its base spans, written once."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return stored(docs.withColumns({key: F.md5(text), base: base_spans(text)}), "pii-spans")


def _beside(rows: DataFrame, text_col: str, key: str, base: str, least: int) -> DataFrame:
    """The terms beside each entity, a row per different text: ``value``,
    ``term``, ``key`` and the number of documents with the text; of entities
    in ``least`` texts or more. What is stored are the terms of each text; the
    rows are made from them where they are counted or matched."""
    text = F.regexp_replace(F.col(text_col).cast("string"), PATTERNS["email"], " ")
    holding = rows.filter(F.size(base) > 0).select(F.col(key).alias("key"), F.col(base).alias("spans"), text.alias("text"))
    each = holding.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("text").alias("text"), F.first("spans").alias("spans"))
    each = stored(each.select("key", "n", _units(F.col("spans")).alias("values"), _terms(F.col("text")).alias("terms")), "pii-holding")
    per_value = each.select(F.explode("values").alias("value"), "n").groupBy("value").agg(
        F.sum("n").alias("n_value"), F.count(F.lit(1)).alias("texts"))
    judged = per_value.filter(F.col("texts") >= least)
    pairs = each.select("key", "n", "terms", F.explode("values").alias("value")).join(judged, "value")
    return pairs.select("value", "n_value", F.col("texts").alias("value_texts"), "key", "n", F.explode("terms").alias("term"))


def _disclosing(rows: DataFrame, beside: DataFrame, text_col: str, alpha: float, least: int) -> DataFrame:
    pairs = beside.groupBy("value", "term").agg(
        F.sum("n").alias("n_pair"), F.count(F.lit(1)).alias("texts"), F.first("n_value").alias("n_value"), F.first("value_texts").alias("value_texts")
    ).filter(F.col("texts") >= least)
    # counted before they meet the pairs: what is shuffled are a task's
    # different terms, not the terms of every document
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    per_term = rows.select(F.explode(_terms(text)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    n = F.lit(float(max(rows.count(), 1)))
    pmi = F.log2(n * F.col("n_pair") / (F.col("n_term") * F.col("n_value")))
    # the texts with the term are at least those with both
    few = F.least("n_term", F.greatest("value_texts", "texts"))
    return (
        pairs.join(per_term, "term")
        .withColumn("ic", F.log2(n / F.col("n_value")))
        .withColumn("pmi", pmi * _discount(F.col("texts")) * _discount(few))
        .filter((F.col("ic") > 0) & (F.col("pmi") >= F.col("ic") * alpha))
        .select("value", "term", "pmi", "ic")
    )


def disclosing_terms(docs: DataFrame, text_col: str = "text", alpha: float = ALPHA) -> DataFrame:
    """``(value, term)`` of the terms that disclose an entity, with their
    discounted ``pmi`` and the entity's information content ``ic``."""
    rows = spanned(docs.select(F.col(text_col).alias("text")), "text", "key", "spans")
    least = least_texts(alpha)
    return _disclosing(rows, _beside(rows, "text", "key", "spans", least), "text", alpha, least)


def _term_spans(text: Column, terms: Column, base: Column) -> Column:
    """Occurrences of the terms outside of base spans."""
    words = F.filter(_places(text, r"\p{L}+"), lambda w: F.array_contains(terms, F.lower(w["match"])))
    free = F.filter(words, lambda w: ~F.exists(base, lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"])))
    shaped = F.transform(free, lambda w: F.struct(
        w["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), w["end"].alias("end"),
        F.lit(TERM).alias("kind"), w["match"].alias("match"),
    )).cast(SPAN)
    return F.coalesce(F.when(F.size(terms) > 0, shaped), F.array().cast(SPAN))


def with_spans(docs: DataFrame, text_col: str, base: str, full: str, alpha: float = ALPHA) -> DataFrame:
    """``docs`` with two columns of spans: of the base kinds, and all."""
    key, disclosed = fresh_names([*docs.columns, base, full], ["pii_key", "pii_terms"])
    rows = spanned(docs, text_col, key, base)
    least = least_texts(alpha)
    beside = _beside(rows, text_col, key, base, least)
    found = stored(_disclosing(rows, beside, text_col, alpha, least).select("value", "term"), "pii-terms")
    of_text = beside.join(found, ["value", "term"]).groupBy(F.col("key").alias(key)).agg(F.collect_set("term").alias(disclosed))
    joined = rows.join(stored(of_text, "pii-texts"), key, "left")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    terms = F.coalesce(F.col(disclosed), F.array().cast("array<string>"))
    every = F.array_sort(F.concat(F.col(base), _term_spans(text, terms, F.col(base))))
    return joined.withColumn(full, F.when(F.size(terms) > 0, every).otherwise(F.col(base))).drop(key, disclosed)


def _number_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _written(spans: Column) -> Column:
    return joined_by_comma(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def pii_report(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Per document the counts of the base kinds, a digest of the base spans
    and all spans."""
    require(docs, ["doc_id", "text"])
    found = with_spans(docs.select("doc_id", "text"), "text", "base", "full", alpha)
    counts = [_number_of("base", k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("full")).alias("spans"))


def _without(text: Column, spans: Column) -> Column:
    """The text with base spans generalised to ``<KIND>`` and terms left out.
    Overlapping spans are one, named after the first."""
    merged = F.aggregate(
        spans, F.array().cast("array<struct<start:int,end:int,kind:string>>"),
        lambda a, s: F.when(
            (F.size(a) > 0) & (s["start"] < F.element_at(a, -1)["end"]),
            F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
                F.element_at(a, -1)["start"].alias("start"),
                F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end"), F.element_at(a, -1)["kind"].alias("kind"),
            ))),
        ).otherwise(F.concat(a, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))),
    )
    ends = F.concat(F.array(F.lit(0)), F.transform(merged, lambda s: s["end"]))
    kept = F.zip_with(F.slice(ends, F.lit(1), F.size(merged)), merged, lambda e, s: F.concat(
        F.substr(text, e + 1, s["start"] - e),
        F.when(s["kind"] == TERM, F.lit("")).otherwise(F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))),
    ))
    tail = F.substr(text, F.element_at(ends, -1) + 1, F.length(text))
    return F.concat(F.array_join(kept, ""), tail)


def sanitised(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """``docs`` with the texts sanitised; ``n_chars``, if there, follows the
    new text. Documents without a span are unchanged."""
    base, full = fresh_names(docs.columns, ["base", "full"])
    found = with_spans(docs, "text", base, full, alpha)
    changed = F.size(full) > 0
    out = found.withColumn("text", F.when(changed, _without(F.col("text").cast("string"), F.col(full))).otherwise(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)
