"""Token numbers in binary files with Elias-Fano document boundaries.

Documents are dealt by ranges of ``doc_id`` and sorted, so that files follow
each other in ascending order. A task writes its documents' numbers into
files of at most ``MAX_IDS``, in the shared folder, under a name of its own
attempt; only the rows of tasks that succeeded name files, so a repeated
task leaves at most an unused file. A file is

    magic, bytes per number, documents, documents without an id (first),
    smallest id; Elias-Fano of the boundaries (documents + 1 places in the
    number array), Elias-Fano of the ids above the smallest, the numbers.

Numbers take two bytes when the vocabulary allows it. ``TokenFile`` finds a
document's numbers through the boundaries alone.

Defined results: a null or empty text has the end number only; rows without
an id come first; rows of equal id stand in the order of a hash of their
text; an empty table gives no file; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.bounded import BoundedCache
from tessera.llm.common import require, shared_path, stored
from tessera.llm.elias_fano import EliasFano

MAGIC = b"TOKSEF01"
HEAD = struct.Struct("<8sBQQq")
MAX_IDS = 1 << 25  # of one file
CACHED = 400_000  # encoded words kept per generation in a worker
BLOCK_CHARS = 1 << 21  # of texts encoded together
JOINED = 64  # words given to the library as one text


class LibraryEncoder:
    """The tokenizers library, asked once for each distinct word; texts
    become the bytes of their numbers.

    Where all white space is single spaces and line feeds between words, the
    byte-level pattern never crosses from a word to the space after it, and
    neither does a special string without white space: a word with the space
    or line feed before it can be encoded alone, or joined to others like it
    and cut apart where its bytes end. Other texts go to the library whole,
    long ones in parts cut before such a space.
    """

    def __init__(self, tokenizer_file: str):
        self.library = Tokenizer.from_file(tokenizer_file)
        self.library.no_truncation()
        self.library.no_padding()
        self.pieces = BoundedCache(CACHED)
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        special = self.library.get_added_tokens_decoder()
        if any(s.content.split() != [s.content] or s.lstrip or s.rstrip for s in special.values()):
            raise ValueError("a special string takes in white space")
        # a byte is one character of a byte-level vocabulary's strings
        self.n_bytes = np.array([len(self.library.id_to_token(i) or "") for i in range(size)])
        for i, s in special.items():
            self.n_bytes[i] = len(s.content.encode())
        self.line_feed = self.whole("\n")

    def _numbers(self, texts: list[str]) -> np.ndarray:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return np.fromiter(chain.from_iterable(e.ids for e in found), dtype=self.kind)

    def whole(self, text: str) -> bytes:
        """A text that is not looked up by words."""
        parts, at = [], 0
        while at < len(text):
            end = at + BLOCK_CHARS
            while end < len(text) and not (text[end] == " " and not text[end - 1].isspace() and not text[end + 1 : end + 2].isspace()):
                end += 1
            parts.append(self._numbers([text[at:end]]).tobytes())
            at = end
        return b"".join(parts)

    def _words(self, pieces: list[str]) -> dict[str, bytes]:
        """Numbers of words, joined ``JOINED`` at a time for the library."""
        texts = [p if p.startswith("\n") else f" {p}" for p in pieces]
        numbers = self._numbers(["".join(texts[i : i + JOINED]) for i in range(0, len(texts), JOINED)])
        ends = np.cumsum(self.n_bytes[numbers])
        word_ends = np.cumsum([len(t.encode("utf-8", "surrogatepass")) for t in texts])
        last = np.searchsorted(ends, word_ends)
        if not (ends[np.minimum(last, len(ends) - 1)] == word_ends).all():
            raise ValueError("the vocabulary is not byte-level")
        data, width = numbers.tobytes(), self.kind.itemsize
        cuts = [0, *((last + 1) * width).tolist()]
        return {p: data[s:e] for p, s, e in zip(pieces, cuts, cuts[1:])}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Numbers of texts that are few and short enough to be held several
        times."""
        split = [f"\n{t}".replace("\n", " \n").split(" ")[1:] for t in texts]
        known, missing = self.pieces.get_many(set().union(*split))
        new, apart = [], set()
        for p in missing:
            word = p[1:] if p.startswith("\n") else p
            if word.split() == [word]:
                new.append(p)
            else:
                apart.add(p)
        if new:
            found = self._words(new)
            known |= found
            self.pieces.put_many({p: v for p, v in found.items() if len(p) < 64})
        skip = len(self.line_feed)
        return [
            self.whole(t) if apart and not apart.isdisjoint(s) else b"".join(map(known.__getitem__, s))[skip:]
            for t, s in zip(texts, split)
        ]

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Numbers of each text in turn; texts are encoded together up to
        ``BLOCK_CHARS``."""
        held, size = [], 0
        for t in texts:
            if len(t) > BLOCK_CHARS:
                yield from self.encode(held)
                held, size = [], 0
                yield self.whole(t)
                continue
            held.append(t)
            size += len(t)
            if size > BLOCK_CHARS:
                yield from self.encode(held)
                held, size = [], 0
        yield from self.encode(held)


@lru_cache(maxsize=2)
def library_encoder(tokenizer_file: str) -> LibraryEncoder:
    return LibraryEncoder(tokenizer_file)


def file_bytes(doc_ids: list[int | None], numbers: list[bytes], kind: np.dtype) -> list[bytes]:
    """A file's parts. ``doc_ids`` ascend, those without an id first."""
    given = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    smallest = int(given[0]) if len(given) else 0
    bounds = np.concatenate([[0], np.cumsum([len(n) // kind.itemsize for n in numbers], dtype=np.int64)])
    above = given.astype(np.uint64) - np.uint64(smallest % (1 << 64))
    head = HEAD.pack(MAGIC, kind.itemsize, len(doc_ids), len(doc_ids) - len(given), smallest)
    return [head, EliasFano.of(bounds).to_bytes(), EliasFano.of(above).to_bytes(), *numbers]


class TokenFile:
    """Reads a file: documents by their place in it."""

    def __init__(self, data):
        view = memoryview(data)
        magic, width, self.n_docs, self.n_without_id, self.smallest = HEAD.unpack_from(view, 0)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.bounds, at = EliasFano.from_buffer(view, HEAD.size)
        self.ids_above, at = EliasFano.from_buffer(view, at)
        self.numbers = np.frombuffer(view, dtype="<u2" if width == 2 else "<u4", offset=at)

    def offsets(self) -> np.ndarray:
        """Places of all documents' first numbers, and the end."""
        return self.bounds.get(np.arange(self.n_docs + 1)).astype(np.int64)

    def doc_ids(self) -> list[int | None]:
        given = self.ids_above.get(np.arange(self.n_docs - self.n_without_id)) + np.uint64(self.smallest % (1 << 64))
        return [None] * self.n_without_id + given.view(np.int64).tolist()

    def document(self, i: int) -> np.ndarray:
        start, end = self.bounds.get(np.array([i, i + 1])).astype(np.int64)
        return self.numbers[start:end]


def write_tokens(docs: DataFrame, tokenizer_file: str, path: str, end_id: int = 0) -> DataFrame:
    """Writes the files under ``path`` and returns what names them: ``part``
    and ``k`` (their order), ``file``, ``n_docs``, ``n_ids``."""
    require(docs, ["doc_id", "text"])
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .drop("tie")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer_file)
        files, folder = fs.FileSystem.from_uri(path)
        files.create_dir(folder, recursive=True)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        end = np.array([end_id], dtype=encoder.kind).tobytes()
        ids: list = []
        numbers: list[bytes] = []
        size, k = 0, 0

        def flush() -> pa.RecordBatch:
            name = f"{folder}/tokens-{part:06d}-{k:04d}-{attempt}.bin"
            with files.open_output_stream(name, compression=None) as out:
                for x in file_bytes(ids, numbers, encoder.kind):
                    out.write(x)
            row = {"part": part, "k": k, "file": name, "n_docs": len(ids), "n_ids": size}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema(
                [("part", pa.int32()), ("k", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]
            ))

        for b in batches:
            for d, found in zip(b.column(0).to_pylist(), encoder.encode_all(b.column(1).to_pylist())):
                ids.append(d)
                numbers.append(found + end)
                size += len(numbers[-1]) // encoder.kind.itemsize
                if size >= MAX_IDS:
                    yield flush()
                    ids, numbers, size, k = [], [], 0, k + 1
        if ids:
            yield flush()

    return stored(ordered.mapInArrow(run, "part int, k int, file string, n_docs long, n_ids long"), "token-files")


def _each_file(named: DataFrame) -> DataFrame:
    """``named`` dealt so that files are read by as many tasks as there are
    files, up to a thousand for each core."""
    n = named.count()
    return named.repartition(max(1, min(n, 1000 * named.sparkSession.sparkContext.defaultParallelism)))


def read_tokens(named: DataFrame, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start`` (numbers of all
    documents before it), ``n_tokens``, ``ids_crc32``. The starts of files
    are sums over one row per file."""
    before = Window.orderBy("part", "k").rowsBetween(Window.unboundedPreceding, -1)
    placed = named.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = fs.FileSystem.from_uri(path)
        for b in batches:
            for row in b.to_pylist():
                with files.open_input_file(row["file"]) as f:
                    tokens = TokenFile(f.read())
                at = tokens.offsets()
                crcs = [zlib.crc32(tokens.numbers[s:e].astype("<u4")) for s, e in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (tokens.doc_ids(), row["start"] + at[:-1], np.diff(at), crcs)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return _each_file(placed).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_report(docs: DataFrame, tokenizer_file: str, end_id: int = 0) -> DataFrame:
    """Writes the files to the shared folder and reads every document back."""
    path = shared_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, tokenizer_file, path, end_id), path)
