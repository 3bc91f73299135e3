"""Licence scan: TF-IDF cosine to templates, then inheritance by path.

Every line, paragraph and whole text of at least ``LEAST_WORDS`` words is
compared with the templates. A term weighs its number in the unit times its
inverse document frequency over all files, words that no template has too.
The template that is best for a unit and their dot product depend on template
terms only. Units that would reach ``LEAST`` if their other words stood in all
files are kept with these words, whose document frequencies are then joined;
none is missed. A unit has the licence of its best template at a cosine of
``LEAST`` or more.

A licence file is one whose whole text is a template's, or is named like one
and has a licence. A file without a licence of its own takes that of the
licence file in the nearest directory above. Ancestors are joined per
distinct directory, files to their directory; a directory with very many
files is a plain join key, which adaptive execution splits.

Defined results: a null text is empty and has no licence of its own; a null
path is in no directory and inherits nothing; of several licence files in a
directory the best cosine counts, then the smallest licence, then path;
equal cosines of templates go to the smaller licence; repeated rows are each
scanned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import require, stored
from tessera.llm.licence_texts import NOTICES

LEAST = 0.75
LEAST_WORDS = 3
ROWS_AT_A_TIME = 500
LICENCE_NAME = r"(?i)^(licen[sc]e|copying|unlicense)([.-].*)?$"
#: A-Z lower-cased; line feeds stay; other bytes that are not digits, letters or non-ASCII become a space.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c == 10 or 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
BASES = ("file", "paragraph", "line")
NOT_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # between words whose A-Z are lower-cased
TERMS_AT_A_TIME = 50_000
UNITS = "array<struct<rank:int,licence:string,dot:double,square:double,others:array<struct<word:binary,tf:int>>>>"
UNITS_ARROW = pa.list_(pa.struct([
    ("rank", pa.int32()), ("licence", pa.string()), ("dot", pa.float64()), ("square", pa.float64()),
    ("others", pa.list_(pa.struct([("word", pa.binary()), ("tf", pa.int32())]))),
]))


class Templates:
    """Licences by template, their terms, and the matrix of term numbers."""

    def __init__(self, notices: dict[str, list[str]]):
        pairs = [(k, t) for k in sorted(notices) for t in [f"SPDX-License-Identifier: {k}", *notices[k]]]
        self.licences = [k for k, _ in pairs]
        split = [t.encode().translate(WORD_BYTES).split() for _, t in pairs]
        self.terms = {w: i for i, w in enumerate(sorted({w for t in split for w in t}))}
        self.counts = np.zeros((len(pairs), len(self.terms)))
        for row, t in zip(self.counts, split):
            for w in t:
                row[self.terms[w]] += 1

    def words(self, text: str | None) -> list[list[bytes]]:
        """The words of each line."""
        return [x.split() for x in (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split(b"\n")]

    def numbers(self, lines: list[list[bytes]]) -> list[np.ndarray]:
        """Per line the numbers of its words, -1 for a word of no template."""
        get = self.terms.get
        return [np.fromiter(map(get, w, repeat(-1)), dtype=np.int64, count=len(w)) for w in lines]


@lru_cache(maxsize=1)
def templates() -> Templates:
    return Templates(NOTICES)


def document_frequencies(files: DataFrame, known: Templates) -> tuple[int, np.ndarray]:
    """Files, and files with each template term: one row per term reaches
    the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(known.terms) + 1, dtype=np.int64)
        for b in batches:
            for t in b.column(0):
                at = np.unique(np.concatenate(known.numbers(known.words(t.as_py()))))
                n[at[at >= 0]] += 1
            n[-1] += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n)), pa.int32()), pa.array(n)], names=["term", "n"])

    total = np.zeros(len(known.terms) + 1, dtype=np.int64)
    for r in files.select("text").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        total[r.term] = r.n
    return int(total[-1]), total[:-1]


class Scanner:
    def __init__(self, known: Templates, n_files: int, df: np.ndarray):
        self.known = known
        self.idf = np.log((n_files + 1) / (df + 1)) + 1
        weighted = known.counts * self.idf
        self.matrix = np.ascontiguousarray((weighted / np.linalg.norm(weighted, axis=1, keepdims=True)).T)

    def best(self, unit: np.ndarray, number: np.ndarray, n_units: int) -> tuple[np.ndarray, ...]:
        """Units that may reach ``LEAST``, with their template, the dot
        product with it and the square of their template terms. ``unit`` and
        ``number`` are of every word. A word of no template weighs 1 or more."""
        n_terms = len(self.idf)
        has = number >= 0
        key, tf = np.unique(unit[has] * n_terms + number[has], return_counts=True)
        at, term = np.divmod(key, n_terms)
        weight = tf * self.idf[term]
        on_terms = np.bincount(at, weights=weight * weight, minlength=n_units)
        words = np.bincount(unit, minlength=n_units)
        least = on_terms + np.bincount(unit[~has], minlength=n_units)
        chosen = (words >= LEAST_WORDS) & (on_terms >= LEAST**2 * least * (1 - 1e-9)) & (on_terms > 0)
        mine = chosen[at]
        at, term, weight = at[mine], term[mine], weight[mine]
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, int)
        units, ends = at[starts], np.r_[starts[1:], len(at)] if len(at) else starts
        found = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0))]
        i = 0
        while i < len(units):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + TERMS_AT_A_TIME, "right")))
            lo, hi, u = starts[i], ends[j - 1], units[i:j]
            dots = np.add.reduceat(self.matrix[term[lo:hi]] * weight[lo:hi, None], starts[i:j] - lo, axis=0)
            cos = np.round(dots / np.sqrt(least[u])[:, None], 9)
            top = cos.argmax(axis=1)  # templates are in the order of their licence
            ok = np.flatnonzero(cos[np.arange(len(u)), top] >= LEAST)
            found.append((u[ok], top[ok], dots[ok, top[ok]], on_terms[u[ok]]))
            i = j
        return tuple(np.concatenate(x) for x in zip(*found))

    def scan(self, texts: list) -> list[list[dict]]:
        """Per text its lines, paragraphs and itself that may have a
        licence, with the words of theirs that no template has."""
        per_line, line_text, line_paragraph = [], [], []
        paragraph = 0
        for i, t in enumerate(texts):
            paragraph += 1
            for words in self.known.words(t):
                if not words:
                    paragraph += 1
                    continue
                per_line.append(words)
                line_text.append(i)
                line_paragraph.append(paragraph)
        out: list[list[dict]] = [[] for _ in texts]
        if not per_line:
            return out
        sizes = np.array([len(w) for w in per_line])
        number = np.concatenate(self.known.numbers(per_line))
        line = np.repeat(np.arange(len(per_line)), sizes)
        text_of_line = np.array(line_text)
        _, paragraph_of_line = np.unique(line_paragraph, return_inverse=True)
        text_of_paragraph = np.zeros(paragraph_of_line[-1] + 1, dtype=np.int64)
        text_of_paragraph[paragraph_of_line] = text_of_line
        for rank, unit_of_line, owner in (
            (0, text_of_line, np.arange(len(texts))),
            (1, paragraph_of_line, text_of_paragraph),
            (2, np.arange(len(per_line)), text_of_line),
        ):
            for u, template, dot, square in zip(*self.best(unit_of_line[line], number, len(owner))):
                lo, hi = np.searchsorted(unit_of_line, [u, u + 1])
                others = Counter(w for x in per_line[lo:hi] for w in x if w not in self.known.terms)
                out[owner[u]].append({
                    "rank": rank, "licence": self.known.licences[template], "dot": float(dot), "square": float(square),
                    "others": [{"word": w, "tf": n} for w, n in others.items()],
                })
        return out


def own_licences(files: DataFrame) -> DataFrame:
    """Every column of ``files`` but the text, and what a file's own text
    says: ``own_licence``, ``cosine``, ``basis`` (whether a line, a paragraph
    or the whole text has it), ``licences``, and ``whole``: whether the whole
    text has a licence, also where a part of it is closer to a template."""
    known = templates()
    rest = [c for c in files.columns if c != "text"]
    n_files, df = document_frequencies(files, known)
    scanner = Scanner(known, n_files, df)
    schema = T.StructType([*(files.schema[c] for c in rest), T.StructField("units", T._parse_datatype_string(UNITS))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, ROWS_AT_A_TIME):
                part = b.slice(i, ROWS_AT_A_TIME)
                units = pa.array(scanner.scan(part.column("text").to_pylist()), UNITS_ARROW)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), units], names=schema.names)

    rows = stored(files.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "licence-rows")
    units = rows.select("row", F.posexplode("units").alias("place", "unit")).select("row", "place", "unit.*")
    others = units.select("row", "place", F.explode("others").alias("other")).select("row", "place", F.col("other.word").cast("string").alias("word"), "other.tf")
    words = stored(others.select("word").distinct(), "licence-words")
    low = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    frequencies = stored(
        files.select(F.explode(F.array_distinct(F.split(low, NOT_WORDS))).alias("word")).join(words, "word", "left_semi")
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")), "licence-frequencies"
    )
    weight = F.col("tf") * (F.log(F.lit(n_files + 1.0) / (F.col("n") + 1)) + 1)
    squares = others.join(frequencies, "word").groupBy("row", "place").agg(F.sum(weight * weight).alias("more"))
    cosine = F.least(F.round(F.col("dot") / F.sqrt(F.col("square") + F.coalesce("more", F.lit(0.0))), 9), F.lit(1.0))
    of_row = (
        units.drop("others").join(squares, ["row", "place"], "left").withColumn("cosine", cosine).filter(F.col("cosine") >= LEAST)
        .groupBy("row").agg(
            F.min(F.struct((-F.col("cosine")).alias("less"), "licence", "rank")).alias("first"),
            F.array_sort(F.collect_set("licence")).alias("licences"), F.max(F.col("rank") == 0).alias("whole"),
        )
    )
    return rows.drop("units").join(of_row, "row", "left").select(
        *rest, F.col("first.licence").alias("own_licence"), (-F.col("first.less")).alias("cosine"),
        F.element_at(F.array(*map(F.lit, BASES)), F.col("first.rank") + 1).alias("basis"),
        F.coalesce("licences", F.array().cast("array<string>")).alias("licences"), F.coalesce("whole", F.lit(False)).alias("whole"),
    )


def licence_scan(files: DataFrame, id_col: str, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """Per file: its id, ``path``, ``licence``, ``cosine``, ``basis`` (line,
    paragraph, file or inherited), ``licence_file`` (path of the file it is
    inherited from), ``licences`` (all that its own text has)."""
    require(files, [id_col, path_col, text_col])
    slim = files.select(F.col(id_col).alias("id"), F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))
    own = own_licences(slim).withColumn("directory", F.when(
        F.col("path").isNotNull(), F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise("")))
    own = stored(own, "licences")
    named = F.regexp_extract("path", "[^/]*$", 0).rlike(LICENCE_NAME)
    licence_files = own.filter(F.col("own_licence").isNotNull() & F.col("path").isNotNull() & (F.col("whole") | named))
    first = F.min(F.struct((-F.col("cosine")).alias("less"), "own_licence", "path")).alias("first")
    of_directory = licence_files.groupBy("directory").agg(first)
    depth = F.when(F.col("ancestor") == "", 0).otherwise(F.size(F.split("ancestor", "/")))
    parts = F.split("directory", "/")
    above = F.when(F.col("directory") == "", F.array(F.lit(""))).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    )
    ancestors = own.filter("directory is not null").select("directory").distinct().select("directory", F.explode(above).alias("ancestor"))
    # written, so that the join of the files is of two plain sides, of which
    # the one with a hot directory can be split
    nearest = stored(
        ancestors.join(of_directory.withColumnRenamed("directory", "ancestor"), "ancestor")
        .groupBy("directory").agg(F.max_by("first", depth).alias("inherited")),
        "licence-directories",
    )
    joined = own.join(nearest, "directory", "left")
    has = F.col("own_licence").isNotNull()
    return joined.select(
        F.col("id").alias(id_col), "path",
        F.coalesce("own_licence", "inherited.own_licence").alias("licence"),
        F.when(has, F.col("cosine")).otherwise(-F.col("inherited.less")).alias("cosine"),
        F.when(has, F.col("basis")).when(F.col("inherited").isNotNull(), "inherited").alias("basis"),
        F.when(~has, F.col("inherited.path")).alias("licence_file"),
        "licences",
    )
