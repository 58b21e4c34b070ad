"""SentencePiece encoding and decoding through a table of distinct marked words.

Pieces never cross the white-space marker in front of a word (checked on the model file), so a text is
cut into marked words, each distinct word is segmented and decoded once by the sentencepiece library,
and its ids are joined back by position.  The table is local to a worker and bounded in entries and bytes: a table of all
distinct words of the corpus would grow with it, and joining it back through a shuffle would move every
word of every text.  A forgotten word is segmented again, with the same result.

Edge cases: null and empty texts have no ids and decode to the empty text; a literal marker character
is read as a space, as the library does; very long unbroken texts are one word, which
is not kept after its batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, released, resident, slices, tokenizer_path
from .piece_bpe import MARK, PieceModel

DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class WordCodec:
    """Exact ids and decoded texts from the table of distinct words."""

    def __init__(self, path: str, memo_size: int = 80_000):
        self.model, self.memo = PieceModel(path), Memo(memo_size)
        self.odd: dict[str, str] = {}  # words of the batch whose decoded text is not the word itself

    def _learn(self, words: list[str]) -> None:
        # The library puts the first mark itself.  A word without one (a part after a line break, say) is
        # segmented behind a line break, which stands alone in every chunking that makes such words.
        lib = self.model.lib
        bare = [w[1:].replace(MARK, " ") if w[0] == MARK else f"\n{w.replace(MARK, ' ')}" for w in words]
        encoded = lib.encode(bare, num_threads=1)
        cut = len(lib.encode("\n"))
        alone = lib.piece_to_id(MARK)
        encoded = [[alone] if w == MARK else ids if w[0] == MARK else ids[cut:]
                   for w, ids in zip(words, encoded, strict=True)]
        decoded = lib.decode(encoded) if encoded else []
        self.memo.put((word, ",".join(map(str, ids))) for word, ids in zip(words, encoded, strict=True))
        for word, text in zip(words, decoded, strict=True):
            if text != (word[1:] if word[0] == MARK else word).replace(MARK, " "):
                self.odd[word] = text

    def encode_csv(self, texts: list[str]) -> tuple[list[str], list[str]]:
        """Per text its ids as decimals joined by commas, and the text they decode to."""
        words = [self.model.chunks(t) for t in texts]
        self.odd = {}
        missing = self.memo.missing(words)
        if missing:
            self._learn(missing)
        get = self.memo.young.__getitem__
        csv = [",".join(map(get, own)) for own in words]
        decoded = []
        for text, own in zip(texts, words, strict=True):
            if self.odd and not self.odd.keys().isdisjoint(own):
                parts = [self.odd.get(w, w[1:] if w[0] == MARK else w) for w in own]
                marks = [" " if w[0] == MARK else "" for w in own]
                decoded.append("".join(m + p for m, p in zip(marks, parts, strict=True))[1:].replace(MARK, " "))
            else:
                decoded.append(text.replace(MARK, " "))
        self.memo.once += self.odd  # a word whose text changes is decoded again with each batch
        self.memo.trim()
        return csv, decoded

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [[int(i) for i in csv.split(",")] if csv else [] for csv in self.encode_csv(texts)[0]]


def _codec(path: str) -> WordCodec:
    return resident(("codec", path), lambda: WordCodec(path))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encode(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row doc_id and ``ids`` (array of int), exactly the library's, without begin or end ids."""
    path = tokenizer or tokenizer_path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in released(batches):
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, 1_000_000):
                ids = codec.encode([t or "" for t in texts[a:b]])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(ids, pa.list_(pa.int32()))],
                                                 ["doc_id", "ids"])

    return _source(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(ids: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row doc_id and the ``text`` that the library's decode gives; null ids decode to the empty text."""
    path = tokenizer or tokenizer_path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = _codec(path).model.lib
        for batch in released(batches):
            rows = [r or [] for r in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([lib.decode(r) if r else "" for r in rows], pa.string())],
                                             ["doc_id", "text"])

    return ids.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by
    commas) and decoded_sha256 (of the decoded text in UTF-8)."""
    path = tokenizer or tokenizer_path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in released(batches):
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, 1_000_000):
                csv, decoded = codec.encode_csv([t or "" for t in texts[a:b]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.array([c.count(",") + 1 if c else 0 for c in csv], pa.int64()),
                     pa.array([hashlib.sha256(c.encode()).hexdigest() for c in csv], pa.string()),
                     pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _source(docs, id_col, text_col).mapInArrow(run, DIGEST_SCHEMA)
