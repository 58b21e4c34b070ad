"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order tree of byte contexts up to three bytes deep.  A byte is coded in the
longest known context; where it was never seen there, an escape is paid and the next shorter context is
asked, down to a uniform choice of 256 bytes.  An escape after a context has the probability
``d / (n + d)`` (``d`` distinct next bytes in ``n`` visits).  The statistics are frozen after training, so
the exact code length of a byte is a fixed number for (context, byte, language).  Each language holds its own trees
as sorted tables of what it has seen: the grams of four and of three bytes with their code lengths and the contexts of three
and of two bytes with their escapes; the shortest contexts are a full table.  So the model grows with what was
learnt, language by language, and no context is given up however many languages there are.  The distinct grams of
a slice of texts are looked up together.  A text goes to the language with the shortest code.

Training counts contexts in Spark on a bounded sample of the labelled rows (``max_docs`` rows a language,
chosen by a hash of the id; the bound is this parameter).

Edge cases: a null text or one without any letter is ``und`` with score 0; without labelled rows every
text is ``und``; rows with a null id are predicted but never learnt from; invented languages of one text are
languages like others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_residents, release, released, slices

PREDICTION_SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
_PAD = b"\n\n\n"  # context in front of a text


@dataclass
class Trees:
    """One language.  ``grams[0]`` and ``grams[1]`` are the (sorted grams, bits) of four and three bytes, ``escapes``
    the (sorted contexts, bits) of three and two, ``short`` the bits after each single byte."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    escapes: list[tuple[np.ndarray, np.ndarray]]
    short: np.ndarray

    def bits(self, gram: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each gram (ascending, four bytes as a number) after the three others."""
        total = np.zeros(len(gram))
        open_ = np.arange(len(gram))
        for (seen, bits), (contexts, escape), mask in zip(self.grams, self.escapes, (0xFFFFFFFF, 0xFFFFFF), strict=True):
            own = gram[open_] & np.uint32(mask)
            hit, at = _place(seen, own)
            total[open_[hit]] += bits[at[hit]]
            open_, own = open_[~hit], own[~hit]
            known, at = _place(contexts, own >> np.uint32(8))
            total[open_[known]] += escape[at[known]]
        total[open_] += self.short[gram[open_] & np.uint32(0xFFFF)]
        return total


def _place(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are in the sorted table, and where."""
    if not len(table):
        return np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return table[at] == keys, at


@dataclass
class Model:
    languages: list[str]
    trees: list[Trees]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        gram, begins = _grams(texts)
        distinct, place = np.unique(gram, return_inverse=True)
        edges = np.empty(2 * len(texts), dtype=np.int64)
        edges[0::2], edges[1::2] = begins, begins + sizes
        out = np.zeros((len(texts), len(self.languages)))
        for k, trees in enumerate(self.trees):
            bits = np.append(trees.bits(distinct)[place], 0.0)
            out[:, k] = np.add.reduceat(bits, np.minimum(edges, len(bits) - 1))[0::2]
        out[sizes == 0] = 0
        return out


def _grams(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of each text with the three before it, as a 32-bit number, and where each text begins; the three
    grams between two texts, which mix them, are among the numbers."""
    data = np.frombuffer(b"".join([_PAD + r for r in raw]), dtype=np.uint8).astype(np.uint32)
    sizes = np.array([len(r) + 3 for r in raw], dtype=np.int64)
    return data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:], np.cumsum(sizes) - sizes


def is_held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1):
    """crc32 of the id as text, modulo ``folds``, is ``fold`` (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def _context_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, three bytes and the next one as a number, how often) for each slice of texts."""
    for batch in released(batches):
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            own = [t for k, t in zip(langs, texts, strict=True) if k == lang]
            for a, b in slices(own, 1_000_000):
                raw = [t.encode("utf-8", "replace") for t in own[a:b]]
                keys, starts = _grams(raw)
                keep = np.ones(len(keys) + 3, dtype=bool)
                for k in (1, 2, 3):  # between two texts
                    keep[np.maximum(starts - k, 0)] = starts == 0
                keys = keys[keep[:-3]]
                keys, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))],
                    ["lang", "gram", "n"])


def compile_trees(gram: np.ndarray, n: np.ndarray) -> Trees:
    """The trees of a language from its counted grams (ascending; three context bytes and the next byte)."""
    grams, escapes, gram = [], [], gram.astype(np.uint32)
    for mask in (0xFFFFFFFF, 0xFFFFFF):
        seen, place = np.unique(gram & np.uint32(mask), return_inverse=True)
        times = np.bincount(place, weights=n, minlength=len(seen))
        contexts, place, kinds = np.unique(seen >> np.uint32(8), return_inverse=True, return_counts=True)
        total = np.bincount(place, weights=times, minlength=len(contexts)) + kinds
        grams.append((seen, -np.log2(times / total[place])))
        escapes.append((contexts, -np.log2(kinds / total)))

    def shorter(counts: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Probabilities in a context from its counts and those of the next shorter one."""
        total, kinds = counts.sum(-1, keepdims=True), (counts > 0).sum(-1, keepdims=True)
        escape = np.where(total > 0, kinds / np.maximum(total + kinds, 1), 1.0)
        return np.where(counts > 0, counts / np.maximum(total + kinds, 1), escape * base)

    p0 = shorter(np.bincount(gram & np.uint32(0xFF), weights=n, minlength=256), np.full(256, 1 / 256))
    p1 = shorter(np.bincount(gram & np.uint32(0xFFFF), weights=n, minlength=1 << 16).reshape(256, 256), p0[None])
    return Trees(grams, escapes, -np.log2(p1.ravel()))


def compile_model(languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """The trees of all languages from counted grams; ``lang`` is the number of a gram's language."""
    order = np.argsort(lang, kind="stable")
    cut = np.searchsorted(lang[order], np.arange(len(languages) + 1))
    return Model(languages, [compile_trees(gram[order[a:b]], n[order[a:b]].astype(np.float64))
                             for a, b in zip(cut[:-1], cut[1:], strict=True)])


def train(labelled: DataFrame, max_docs: int = 1500, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model | None:
    """Learn from rows with a language, a text and an id; about ``max_docs`` rows a language at most."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")) \
        .where("lang IS NOT NULL AND id IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    u = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("language id")), F.lit(1_000_000))
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1_000_000, 10**6 * max_docs // sizes[k] + 1)))])
    sample = rows.where(u < share[F.col("lang")]).select("lang", "text")
    counted = sample.mapInArrow(_context_counts, "lang string, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    if not counted.num_rows:
        return None
    # numbers instead of a text for each of a million rows
    kinds = counted.column("lang").combine_chunks().dictionary_encode()
    place = np.array([languages.index(k) for k in kinds.dictionary.to_pylist()])
    grams = [counted.column(c).to_numpy() for c in ("gram", "n")]
    lang = place[kinds.indices.to_numpy(zero_copy_only=False)]
    del counted, kinds
    model = compile_model(languages, lang, *grams)
    del lang, grams
    release()
    return model


def predict_texts(model: Model | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, score) of each text; the score is the share of the best language when code lengths are
    compared over at most 64 bytes, so it is not driven to 1 by length alone."""
    out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
    if model is None:
        return out
    for a, b in slices(texts, 500_000):
        have = [i for i in range(a, b) if texts[i] and next(filter(str.isalpha, texts[i]), None)]
        if not have:
            continue
        raw = [texts[i].encode("utf-8", "replace") for i in have]
        lengths = model.code_lengths(raw)
        scale = np.minimum(1.0, 64 / np.array([len(r) for r in raw]))
        share = np.exp2(-(lengths - lengths.min(1, keepdims=True)) * scale[:, None])
        best, score = lengths.argmin(1), 1 / share.sum(1)
        for i, k, p in zip(have, best.tolist(), score.tolist(), strict=True):
            out[i] = (model.languages[k], p)
    return out


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred and score, from the text alone.  One pass, no shuffle; the model,
    which grows with the training sample only, is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_residents()
        own = shared.value
        for batch in released(batches):
            found = predict_texts(own, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([k for k, _ in found], pa.string()),
                 pa.array([p for _, p in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), is_held_out(id_col).alias("held_out"),
                         F.col(text_col).alias("text"))
    return source.mapInArrow(run, PREDICTION_SCHEMA)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             max_docs: int = 1500) -> DataFrame:
    """Train on the rows that are not held out, predict every row."""
    model = train(docs.where(~is_held_out(id_col)), max_docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    return predict(docs, model, id_col, text_col)


def keep_identified(docs: DataFrame, model: Model | None, min_score: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known: not ``und`` and a score of at least
    ``min_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_residents()
        own = shared.value
        for batch in released(batches):
            found = predict_texts(own, batch.column(at).to_pylist())
            yield batch.filter(pa.array([k != "und" and p >= min_score for k, p in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
