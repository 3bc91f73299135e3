"""Registered queries of this subpackage: ``name -> callable(spark, sf_dir)``
and, where SQL can express one, its DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bpe import encoding_digests
from tessera.llm.collocations import collocations
from tessera.llm.common import table
from tessera.llm.decontam import contamination_report
from tessera.llm.licences import licence_scan
from tessera.llm.lm_score import pseudo_likelihood
from tessera.llm.merkle import manifest_report
from tessera.llm.pii import pii_report
from tessera.llm.pu_quality import quality_scores
from tessera.llm.quality import quality_report
from tessera.llm.simhash import near_duplicates
from tessera.llm.token_counts import token_counts
from tessera.llm.token_store import token_file_report
from tessera.llm.warc import archive_report

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(table(spark, sf_dir, "documents"))


def op5_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op7_byte_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encoding_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op8_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(table(spark, sf_dir, "pages"))


def op9_masked_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(table(spark, sf_dir, "documents"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files ``<source>/<lang>/<doc_id>.txt``."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licence_scan(docs.select("doc_id", path.alias("path"), "text"), "doc_id")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=30, inside=80, top=2000)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, QueryFn] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_pii": op4_pii,
    "op5_token_id_output": op5_token_id_output,
    "op6_quality_rules": op6_quality_rules,
    "op7_byte_bpe_roundtrip": op7_byte_bpe_roundtrip,
    "op8_warc_captures": op8_warc_captures,
    "op9_masked_lm_scores": op9_masked_lm_scores,
    "op10_licence_scan": op10_licence_scan,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_merkle_manifest": op13_merkle_manifest,
    "pipeline": corpus_pipeline.run,
}

#: Words as DuckDB lists; A-Z are lower-cased by translate.
_SQL_WORDS = (
    "list_filter(regexp_split_to_array(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
)

def _sql_field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({text})) || ':' || {text} END"


def _sql_leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_sql_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


#: CRC-32 of a decimal number, eight shifts a byte.
_SQL_CRC32 = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)), "
    "lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], "
    "lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
)

ORACLE: dict[str, str] = {
    "op2_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS.format(text="coalesce(text, '')")} AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i, w FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM bw),
sizes AS (SELECT DISTINCT n FROM windows),
dw AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN windows
         ON windows.n = dw.n AND windows.s = array_to_string(dw.w[i:i + dw.n - 1], ' ')),
places AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op8_warc_captures": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b)::BIGINT AS n, sha1(b) AS x FROM p),
d AS (SELECT page_id, n, array_to_string(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(x, 1 + 5 * (i // 4), 5))::INTEGER >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '') AS s
      FROM h),
f AS (SELECT *, min(page_id) OVER (PARTITION BY s, n) AS first_id FROM d)
SELECT page_id, n AS payload_bytes, s AS payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to FROM f""",
    "op12_phrase_collocations": r"""
WITH p AS (SELECT doc_id, lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w
           FROM (SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                 FROM documents)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
g AS (SELECT doc_id, lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM p, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f, min(doc_id) AS first_doc FROM g GROUP BY lang, k, phrase HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, f AS a, first_doc, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT *, array_to_string(w[:x], ' ') AS head, array_to_string(w[x + 1:], ' ') AS rest
         FROM (SELECT *, unnest(range(1, k)) AS x FROM c)),
scored AS (SELECT cuts.*, h.f AS l, t.f AS r, ((2000000::HUGEINT * a) // (h.f + t.f))::BIGINT AS score
           FROM cuts JOIN f h ON h.lang = cuts.lang AND h.phrase = head JOIN f t ON t.lang = cuts.lang AND t.phrase = rest),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, x) = 1),
kept AS (SELECT * FROM worst s WHERE NOT EXISTS (
           SELECT 1 FROM (SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS part
                          FROM (SELECT lang, a, w, k, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k)) b
           WHERE b.lang = s.lang AND b.part = s.phrase AND 100::HUGEINT * b.a >= 80::HUGEINT * s.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score, first_doc FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE d AS (SELECT *, coalesce('=' || source, '') AS tree, {_SQL_CRC32} % 2 = 0 AS damaged FROM documents),
l AS (SELECT doc_id, tree, {_sql_leaf("text")} AS leaf,
             CASE WHEN damaged THEN {_sql_leaf("replace(text, chr(10), '')")} ELSE {_sql_leaf("text")} END AS copy FROM d),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                  count(*) OVER (PARTITION BY tree) AS n FROM l),
up AS (SELECT tree, 0 AS level, pos, n, leaf AS h FROM leaves
       UNION ALL
       SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
       FROM up WHERE n > 1 GROUP BY tree, level, pos // 3, n),
subroots AS (SELECT tree, level, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS level, pos, n, h FROM subroots
        UNION ALL
        SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 3, n),
root AS (SELECT h FROM top WHERE n = 1),
steps AS (SELECT v.tree, v.pos, u.level, u.pos < v.pos // (3::BIGINT ** u.level)::BIGINT AS before, u.pos AS place, u.h
          FROM leaves v JOIN up u ON u.tree = v.tree AND u.n > 1
           AND u.pos // 3 = v.pos // (3::BIGINT ** (u.level + 1))::BIGINT AND u.pos <> v.pos // (3::BIGINT ** u.level)::BIGINT
          UNION ALL
          SELECT v.tree, v.pos, s.level + t.level, t.pos < s.pos // (3::BIGINT ** t.level)::BIGINT, t.pos, t.h
          FROM leaves v JOIN subroots s ON s.tree = v.tree JOIN top t ON t.n > 1
           AND t.pos // 3 = s.pos // (3::BIGINT ** (t.level + 1))::BIGINT AND t.pos <> s.pos // (3::BIGINT ** t.level)::BIGINT),
proofs AS (SELECT tree, pos, sha256(string_agg(h, '' ORDER BY level, place)) AS p FROM steps GROUP BY tree, pos),
sides AS (SELECT tree, pos, level, coalesce(string_agg(h, '' ORDER BY place) FILTER (before), '') AS b,
                 coalesce(string_agg(h, '' ORDER BY place) FILTER (NOT before), '') AS a FROM steps GROUP BY tree, pos, level),
heights AS (SELECT s.tree, s.level + (SELECT max(level) FROM top) AS height FROM subroots s),
fold AS (SELECT tree, pos, 0 AS level, copy AS h FROM leaves
         UNION ALL
         SELECT f.tree, f.pos, f.level + 1, sha256(coalesce(s.b, '') || f.h || coalesce(s.a, ''))
         FROM fold f JOIN heights USING (tree) LEFT JOIN sides s ON s.tree = f.tree AND s.pos = f.pos AND s.level = f.level
         WHERE f.level < height),
ends AS (SELECT f.tree, f.pos, f.h FROM fold f JOIN heights USING (tree) WHERE f.level = height)
SELECT v.doc_id, v.leaf, s.h AS subroot, r.h AS root, coalesce(p.p, sha256('')) AS proof_sha256, e.h AS folded_root, e.h = r.h AS verified
FROM leaves v JOIN subroots s USING (tree) JOIN ends e ON e.tree = v.tree AND e.pos = v.pos
LEFT JOIN proofs p ON p.tree = v.tree AND p.pos = v.pos, root r""",
}
