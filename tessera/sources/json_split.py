"""One huge JSON document read by many tasks (SRC-1, PRJ-1).

A document ``{..., "data": [[...], [...], ...], ...}`` has no line that ends
with a record, so Spark's JSON reader gives a file of it to one task. Here the
text reader cuts it at every closing bracket, in as many splits as its size
asks for. What such a piece means depends on all text before it: whether it
begins within a string and how many brackets are open. Both follow from sums.

* Each split is summed up for both ways it may begin: whether it leaves a
  string open, how deep it ends, and how often a bracket closes at each depth.
* Running sums over the splits of a file (one row per split) give the state at
  every split's start and the number of elements before it.
* Each split is read again from its state: the pieces of an element are put
  together again, numbered by the running count; only the parts of an element
  that crosses into the next split meet in a shuffle.

Strings may hold brackets and escapes, elements may hold arrays and objects,
and the array may stand anywhere at the top level, also beside nested fields
of the same name. The elements themselves must be arrays; what is none fails
the read, as a malformed document does.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.tables import materialize

_ESCAPED = re.compile(r"\\.", re.S)
#: Depth of the elements of a top-level field's array: the object, the array.
ARRAY_DEPTH = 2

_PIECES = "source_file string, block long, value string"
_SUMMARY = "source_file string, block long, odd boolean, deltas array<long>, closed array<map<int,long>>"
_PARTS = "source_file string, block long, n long, kind string, seq long, text string"


def _quotes(text: str) -> int:
    return _ESCAPED.sub("", text).count('"')


def _depth(text: str, in_string: bool) -> int:
    """Opened less closed brackets outside strings."""
    return scanned(text)[1 + in_string]


def _brackets(bare: str) -> int:
    return bare.count("[") + bare.count("{") - bare.count("]") - bare.count("}")


def scanned(text: str) -> tuple[bool, int, int]:
    """Whether a piece turns a string on or off, and its opened less closed
    brackets if it begins outside of a string and if it begins within one."""
    parts = (_ESCAPED.sub("", text) if "\\" in text else text).split('"')
    return len(parts) % 2 == 0, _brackets("".join(parts[::2])), _brackets("".join(parts[1::2]))


def array_start(text: str, in_string: bool, depth: int, field: str) -> int | None:
    """Where the array of the top-level ``field`` begins in a piece that
    starts at ``depth``: the place after its bracket."""
    if f'"{field}"' not in text:
        return None
    for m in re.finditer(r'"' + re.escape(field) + r'"\s*:\s*\[', text):
        before = text[: m.start()]
        inside = in_string ^ bool(_quotes(before) % 2)
        if not inside and depth + _depth(before, in_string) == ARRAY_DEPTH - 1:
            return m.end()
    return None


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The text between closing brackets; a bracket was at the end of every
    piece but the last of a file."""
    read = spark.read.option("lineSep", "]").option("recursiveFileLookup", "true").text(path)
    return read.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The pieces of one split that stand together in a batch."""
    for b in batches:
        ends = [pc.run_end_encode(b.column(c)).run_ends.to_numpy() for c in ("source_file", "block")] if b.num_rows else [[]]
        begin = 0
        for end in np.unique(np.concatenate(ends)).tolist():
            run = b.slice(begin, int(end) - begin)
            begin = int(end)
            yield (run.column("source_file")[0].as_py(), run.column("block")[0].as_py()), run


#: What a byte is to the scan.
_QUOTE, _OPEN, _CLOSE, _ESCAPE = 1, 2, 3, 4
_KINDS = np.zeros(256, np.uint8)
for _kind, _chars in ((_QUOTE, b'"'), (_OPEN, b"[{"), (_CLOSE, b"]}"), (_ESCAPE, b"\\")):
    _KINDS[list(_chars)] = _kind


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all pieces and the place after each."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)), at[1:] - at[0]


def scanned_all(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``scanned`` of each piece of ``data``, the pieces ending before ``ends``."""
    kinds = _KINDS[data]
    at = np.flatnonzero(kinds)
    kind = kinds[at]
    piece = np.repeat(np.arange(len(ends)), np.diff(np.searchsorted(at, ends), prepend=0))
    slashes = np.flatnonzero(kind == _ESCAPE)
    if len(slashes):
        # of backslashes in a row every second one is escaped itself
        where, of = at[slashes], piece[slashes]
        order = np.arange(len(slashes))
        first = np.append(True, (np.diff(where) != 1) | (np.diff(of) != 0))
        escaping = (order - np.maximum.accumulate(np.where(first, order, 0))) % 2 == 0
        escaped = where[escaping] + 1
        kept = (kind != _ESCAPE) & ~np.isin(at, escaped[escaped < ends[of[escaping]]])
        at, kind, piece = at[kept], kind[kept], piece[kept]
    quote = kind == _QUOTE
    quotes = np.bincount(piece[quote], minlength=len(ends))
    of = piece[~quote]
    inside = (np.cumsum(quote)[~quote] - (np.cumsum(quotes) - quotes)[of]) % 2 == 1
    sign = np.where(kind[~quote] == _OPEN, 1, -1)
    added = [np.bincount(of[x], weights=sign[x], minlength=len(ends)).astype(np.int64) for x in (~inside, inside)]
    return quotes % 2, *added


def _pieces_with(data: np.ndarray, ends: np.ndarray, wanted: bytes) -> list[int]:
    """The pieces in which ``wanted`` begins."""
    text, found, at = data.tobytes(), [], -1
    while (at := text.find(wanted, at + 1)) >= 0:
        found.append(int(np.searchsorted(ends, at, "right")))
    return sorted(set(found))


def _summaries(pieces: DataFrame) -> DataFrame:
    """One row per split: whether it turns a string on or off, and for both
    ways of beginning the depth that it adds and the number of closings by
    depth."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits: dict[tuple, list] = {}
        for key, rows in _runs(batches):
            odd, deltas, closed = s = splits.setdefault(key, [False, [0, 0], [Counter(), Counter()]])
            turns, outside, within = scanned_all(*_bytes_of(rows.column("value")))
            before = (odd + np.cumsum(turns) - turns) % 2
            for way in (0, 1):
                inside = before ^ way
                closes = inside == turns  # otherwise the bracket stands in a string
                depths = deltas[way] + np.cumsum(np.where(inside, within, outside) - closes)
                deltas[way] = int(depths[-1])
                for depth, n in zip(*np.unique(depths[closes], return_counts=True)):
                    closed[way][int(depth)] += int(n)
            s[0] = bool((odd + turns.sum()) % 2)
        out = [(f, b, odd, deltas, [list(c.items()) for c in closed]) for (f, b), (odd, deltas, closed) in splits.items()]
        columns = list(zip(*out)) if out else [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.map_(pa.int32(), pa.int64())))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["source_file", "block", "odd", "deltas", "closed"])

    return pieces.mapInArrow(run, _SUMMARY)


def _states(summaries: DataFrame) -> DataFrame:
    """The state at the start of each split; a file has one row per split."""
    before = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    count = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0))
    known = summaries.withColumn("in_string", count % 2 == 1)
    way = F.col("in_string").cast("int")
    known = known.withColumns({"delta": F.get("deltas", way), "ends": F.get("closed", way)})
    known = known.withColumn("depth", F.coalesce(F.sum("delta").over(before), F.lit(0)))
    here = F.coalesce(F.try_element_at("ends", (F.lit(ARRAY_DEPTH) - F.col("depth")).cast("int")), F.lit(0))
    return known.withColumn("here", here).select(
        "source_file", "block", "in_string", "depth", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("n"))


def _parts(pieces: DataFrame, states: DataFrame, field: str) -> DataFrame:
    """``element`` rows, ``part`` rows of elements that cross splits, and the
    ``start`` and ``end`` of top-level arrays, with ``n``, the number of
    closings at the array's depth before them, and ``seq``, their place in
    their split."""
    joined = pieces.join(F.broadcast(states), ["source_file", "block"])  # one row per split of the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict[tuple, list] = {}  # in a string, depth, n, text of the element so far, whether from its start, pieces
        out: list[tuple] = []
        names = ["source_file", "block", "n", "kind", "seq", "text"]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())

        def made() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[]] * 6
            found = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            out.clear()
            return found

        for (file, block), rows in _runs(batches):
            begin = [rows.column(c)[0].as_py() for c in ("in_string", "depth", "n")]
            s = now.setdefault((file, block), [*begin, [], begin[1] == ARRAY_DEPTH and not begin[0], 0])
            in_string, depth, n, held, whole, seq = s
            texts = rows.column("value")
            data, ends = _bytes_of(texts)
            turns, outside, within = scanned_all(data, ends)
            inside = (in_string + np.cumsum(turns) - turns) % 2
            closes = inside == turns
            levels = depth + np.cumsum(np.where(inside, within, outside) - closes)  # after each piece
            element = closes & (levels == ARRAY_DEPTH)
            counts = n + np.cumsum(element) - element
            starts = {}
            for i in _pieces_with(data, ends, f'"{field}"'.encode()):
                at = array_start(text := texts[i].as_py(), bool(inside[i]), int(levels[i - 1]) if i else depth, field)
                if at is not None:
                    starts[i] = text[at:]
                    out.append((file, block, int(counts[i]), "start", 2 * (seq + i + 1), None))
            # an element that is one piece goes on as it is
            over = closes & (levels <= ARRAY_DEPTH) & (levels >= ARRAY_DEPTH - 1)  # what is held ends here
            alone = element & np.append(False, over[:-1])
            alone[list(starts)] = False
            if not whole:
                opened = min([*np.flatnonzero(element)[:1].tolist(), *(i - 1 for i in starts)], default=len(ends))
                alone[: opened + 1] = False
            if len(plain := np.flatnonzero(alone)):
                same = [pa.repeat(pa.scalar(v, k), len(plain)) for v, k in ((file, pa.string()), (block, pa.int64()), ("element", pa.string()))]
                yield pa.RecordBatch.from_arrays(
                    [same[0], same[1], pa.array(counts[plain]), same[2], pa.array(2 * (seq + plain + 1)), texts.take(pa.array(plain)).cast(pa.string())], names=names)
            ended = np.maximum.accumulate(np.where(over, np.arange(len(over)), -1))  # the last such piece so far
            last = -1  # the pieces up to it are dealt with
            for i in np.union1d(np.flatnonzero(over & ~alone), np.fromiter(starts, np.int64)).tolist():
                last = max(last, int(ended[i - 1])) if i else last
                if i in starts:
                    held[:] = [starts[i]]
                    whole = True
                else:
                    held += texts.slice(last + 1, i - last).to_pylist()
                last = i
                if element[i]:
                    out.append((file, block, int(counts[i]), "element" if whole else "part", 2 * (seq + i + 1), "]".join(held)))
                    whole = True
                elif over[i]:
                    out.append((file, block, int(counts[i]), "end", 2 * (seq + i + 1) + 1, None))
                if over[i]:
                    held.clear()
            whole = whole or bool(element.any())
            last = max(last, int(ended[-1]))
            held += texts.slice(last + 1).to_pylist()
            now[file, block] = [bool((in_string + turns.sum()) % 2), int(levels[-1]), n + int(element.sum()), held, whole, seq + len(ends)]
            if out:
                yield made()
        for (file, block), (inside, level, count, held, whole, seq) in now.items():
            if held and (level > ARRAY_DEPTH or inside or any(map(str.strip, held))):
                out.append((file, block, count, "part", 2 * seq, "]".join(held)))
        yield made()

    return joined.mapInArrow(run, _PARTS)


def read_split_json(spark: SparkSession, path: str | list[str], field: str = "data", as_of=None, copies: str | None = None) -> DataFrame:
    """The elements of the array ``field`` of each document under ``path``:
    ``source_file``, ``pos`` (from 0) and ``value`` (variant), as
    ``flatten(ingest_json(...))`` gives them, without holding a document in
    one value. ``as_of`` adds the load time. ``copies`` is the folder of what
    the read writes down, for a caller that removes it with the documents."""
    pieces = _pieces(spark, path)
    states = materialize(_states(_summaries(pieces)), copies)
    parts = materialize(_parts(pieces, states, field), copies)  # parsed once, read by its kinds
    at = F.struct("block", "seq", "n")
    bounds = parts.where(F.col("kind").isin("start", "end")).groupBy("source_file").agg(
        F.min(F.when(F.col("kind") == "start", at)).alias("start"), F.collect_list(F.when(F.col("kind") == "end", at)).alias("ends"))
    # other arrays of the top level end as well: the first end after the start
    bounds = bounds.select("source_file", F.col("start.n").alias("first"), F.array_min(F.filter("ends", lambda e: e > F.col("start")))["n"].alias("last"))
    whole = parts.where("kind = 'element'").select("source_file", "n", "text")
    crossing = parts.where("kind = 'part'").groupBy("source_file", "n").agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("p"))
    crossing = crossing.select("source_file", "n", F.array_join(F.transform("p", lambda x: x["text"]), "]").alias("text"))
    # one row per file, so the elements stay where they were read
    every = whole.unionByName(crossing).join(F.broadcast(bounds), "source_file").where("n >= first AND n < last")
    text = F.concat(F.regexp_replace("text", r"^\s*,?\s*", ""), F.lit("]"))
    out = every.select("source_file", (F.col("n") - F.col("first")).cast("int").alias("pos"), F.parse_json(text).alias("value"))
    return out if as_of is None else out.withColumn("load_timestamp", F.lit(as_of).cast("timestamp"))
