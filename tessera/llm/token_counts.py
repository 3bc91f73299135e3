"""Token counts by the whole-token shortcut, for a sentencepiece BPE model.

The model's text is the input with spaces as U+2581 and one such mark in
front. If no piece has the mark after another character, no merge crosses
from a character to a following mark, so the text falls into pre-tokens:
each a run of marks and the characters up to the next one. If no piece has a
line feed, a pre-token can also be cut around it. Both conditions are read
from the model's pieces; a model that breaks one, rewrites text or is not
BPE is refused rather than counted wrongly.

``whole_tokens`` proves, by encoding every vocabulary string alone, which
pre-tokens are one token. Documents are counted by looking pre-tokens up
there; only the rest are merged by the library, each distinct one once per
task as long as the bounded table of results holds it.

Defined results: a null text is empty; empty texts have no bytes and no
tokens; repeated rows are each counted; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from tessera.llm.bounded import BoundedCache
from tessera.llm.common import require

MARK = "▁"
CACHED = 200_000  # results kept per generation in a worker
PIECES_AT_A_TIME = 1 << 16  # pre-tokens of a long text looked at together


class PieceCounter:
    """Counts tokens of texts; built once per worker."""

    def __init__(self, model_file: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        normal = [p.piece for p in model.pieces if p.type == model.SentencePiece.NORMAL]
        self._check(model, normal)
        self.whole = self.whole_tokens(normal)
        self.merged = BoundedCache(CACHED)

    @staticmethod
    def _check(model, normal: list[str]) -> None:
        spec, trainer = model.normalizer_spec, model.trainer_spec
        special = {model.SentencePiece.USER_DEFINED}
        if (
            trainer.model_type != trainer.BPE or trainer.treat_whitespace_as_suffix or not spec.add_dummy_prefix
            or spec.remove_extra_whitespaces or not spec.escape_whitespaces or spec.precompiled_charsmap
            or any(p.type in special for p in model.pieces)
        ):
            raise ValueError("the shortcut needs a BPE model that keeps its text")
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in normal):
            raise ValueError("a piece crosses a pre-token border")

    def whole_tokens(self, normal: list[str]) -> set[str]:
        """Pre-tokens with a mark in front, written as in the text, that are
        one token: each vocabulary string encoded alone."""
        candidates = [p[1:] for p in normal if p.startswith(MARK) and MARK not in p[1:]]
        tokens = self.library.encode(candidates, num_threads=1)
        return {c for c, t in zip(candidates, tokens) if len(t) == 1 and c}

    def _count(self, pieces: list[str]) -> int:
        """Tokens of pre-tokens: one for each that is a whole token, and what
        the library merges for the others, each distinct one once. A
        pre-token that follows a line feed has no mark: it is encoded behind
        the line feed, whose two tokens (the mark and the byte) are taken
        off."""
        whole = self.whole
        rest = [p for p in pieces if p not in whole]
        distinct = set(rest)
        known = {p: n for p in distinct if (n := self.merged.get(p)) is not None}
        new = [p for p in distinct if p not in known]
        for p, t in zip(new, self.library.encode(new, num_threads=1) if new else []):
            known[p] = len(t) - 2 if p.startswith("\n") else len(t)
            self.merged.put(p, known[p])
        return len(pieces) - len(rest) + sum(map(known.__getitem__, rest))

    def count(self, text: str) -> int:
        if not text:
            return 0
        if "  " in text or MARK in text or "\x00" in text or text[0] == " " or " \n" in text or text[-1] == " ":
            return self._count_runs(text)
        lines = text.count("\n")
        pieces = text.replace("\n", " \n").split(" ") if lines else text.split(" ")
        if text[0] == "\n":  # the leading mark stands alone
            lines += 1
            pieces = pieces[1:]
        return lines + sum(self._count(pieces[i : i + PIECES_AT_A_TIME]) for i in range(0, len(pieces), PIECES_AT_A_TIME))

    def _count_runs(self, text: str) -> int:
        """Texts with runs of spaces, or marks of their own: by the library,
        in parts cut where no merge can cross, before a space that follows
        another character."""
        total, at = 0, 0
        while at < len(text):
            end = at + (1 << 20)
            while end < len(text) and not (text[end] == " " and text[end - 1] not in f" {MARK}" and end + 1 < len(text)):
                end += 1
            total += len(self.library.encode(text[at:end]))
            at = end + 1 if end < len(text) else end  # the library puts the mark back
        return total


@lru_cache(maxsize=2)
def piece_counter(model_file: str) -> PieceCounter:
    return PieceCounter(model_file)


def token_counts(docs: DataFrame, model_file: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: ``doc_id``, ``n_bytes``, ``n_tokens`` and whether that
    is over ``limit``. ``model_file`` must be readable where tasks run."""
    require(docs, [id_col, text_col])
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([slim.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = piece_counter(model_file)
        for b in batches:
            texts = b.column(1)
            sizes = pa.compute.binary_length(texts).cast(pa.int64())
            counts = pa.array([counter.count(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), sizes, counts], names=schema.names)

    return slim.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
