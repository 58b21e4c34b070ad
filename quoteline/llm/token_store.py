"""Token-id output as directly addressable codes.

A token id is cut into 8-bit chunks, lowest first.  Level ``k`` holds the ``k``-th chunk of every id
that has one, as plain bytes, with a bitmap that marks the ids that continue on the next level and a
rank directory (the number of marks before every 512th bit).  The chunk of token ``i`` on the next
level is at ``rank(i)``, so any token is read with one byte per level: nothing else is decoded.

A store is a folder of Parquet files written by Spark's committer, so a lost executor only repeats its
tasks.  A row is a *segment*: whole documents, in ascending document order, with the payload described at
:func:`encode_segment`.  ``part`` numbers the range partitions in document order.

Edge cases: a null or empty text is the end token alone; documents with equal ids are stored one after
the other (ordered by a hash of their text), each with its own start; an empty table gives an empty store.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Memo, released, resident, slices, tokenizer_path
from .words import BYTE_BASES, block_hashes

MAGIC = b"DAC1"
RANK_STEP = 512
SEGMENT_SCHEMA = "part int, segment int, part_start long, n_tokens long, first_doc long, last_doc long, payload binary"

# --- the codes ---------------------------------------------------------------------------------


def encode_levels(ids: np.ndarray) -> bytes:
    """The levels of one id sequence: count, number of levels, then per level its chunk bytes, its
    bitmap and its rank directory, each with its length in front."""
    rest = np.asarray(ids, dtype=np.uint32)
    out, levels = [], 0
    while True:
        more = rest > 255
        marks = np.packbits(more, bitorder="little")
        ranks = np.concatenate(([0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), RANK_STEP), dtype=np.int64))
                                if len(more) else [])).astype("<u4")
        for blob in ((rest & 255).astype(np.uint8).tobytes(), marks.tobytes(), ranks.tobytes()):
            out.append(struct.pack("<I", len(blob)))
            out.append(blob)
        levels += 1
        rest = rest[more] >> 8
        if not len(rest):
            break
    return struct.pack("<II", len(ids), levels) + b"".join(out)


class Codes:
    """Reader of :func:`encode_levels`; holds views of the bytes, no decoded copy."""

    def __init__(self, blob: bytes):
        view = memoryview(blob)
        self.n, n_levels = struct.unpack_from("<II", view, 0)
        at, self.levels = 8, []
        for _ in range(n_levels):
            parts = []
            for kind in ("u1", "u1", "<u4"):
                (size,) = struct.unpack_from("<I", view, at)
                parts.append(np.frombuffer(view[at + 4 : at + 4 + size], dtype=kind))
                at += 4 + size
            self.levels.append(parts)

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """Token ``i``: one byte per level, found through the rank directory."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, marks, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not marks[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_STEP
            first = block * RANK_STEP >> 3
            before = np.unpackbits(marks[first : (i >> 3) + 1], bitorder="little")[: i - block * RANK_STEP]
            i, shift = int(ranks[block]) + int(before.sum()), shift + 8
        return value

    def all(self) -> np.ndarray:
        """Every token, as unsigned 32-bit integers."""
        out = None
        for chunks, marks, _ in reversed(self.levels):
            values = chunks.astype(np.uint32)
            if out is not None:
                values[np.unpackbits(marks, count=len(chunks), bitorder="little").view(bool)] |= out << np.uint32(8)
            out = values
        return out


def encode_segment(doc_ids: list[int], lengths: list[int], ids: np.ndarray) -> bytes:
    """``DAC1``, the number of documents, their ids and end offsets (64-bit little-endian), the levels.
    A null document id is stored as the smallest 64-bit integer."""
    head = np.array([np.iinfo(np.int64).min if d is None else d for d in doc_ids], dtype="<i8")
    return MAGIC + struct.pack("<I", len(doc_ids)) + head.tobytes() + np.cumsum(lengths).astype("<i8").tobytes() \
        + encode_levels(ids)


def decode_segment(blob: bytes) -> tuple[list, np.ndarray, Codes]:
    """Document ids, end offsets and codes of a segment."""
    if blob[:4] != MAGIC:
        raise ValueError("not a token segment")
    (n,) = struct.unpack_from("<I", blob, 4)
    docs = np.frombuffer(blob, dtype="<i8", count=n, offset=8)
    ends = np.frombuffer(blob, dtype="<i8", count=n, offset=8 + 8 * n)
    null = np.iinfo(np.int64).min
    return [None if d == null else d for d in docs.tolist()], ends, Codes(blob[8 + 16 * n :])


# --- tokenisation ------------------------------------------------------------------------------

# A chunk ends before an ASCII space or line break that follows something else, and before an ASCII mark that
# follows a Latin letter.  The pre-tokenizer never joins characters across such places, so chunks may be
# encoded apart.  Texts with other white space (vertical tab, no-break space, ...) or with an added token's
# string are encoded whole.
_OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")
_JOINABLE = re.compile(rb" [^ \t\n\r]+")  # a chunk that keeps its tokens when such chunks stand in a row
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0D]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_LATIN = np.zeros(256, dtype=bool)  # second bytes after C3: U+00C0 to U+00FF without the two signs
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


class ByteTokenizer:
    """Exact ids of a byte-level tokenizer file through the ``tokenizers`` library.

    The chunks of a slice of texts are hashed together, each distinct one is looked up once in a table
    of ids, bounded in entries and bytes (and encoded if it is not there), and the ids are gathered back by position."""

    def __init__(self, path: str, memo_size: int = 400_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.memo = Memo(memo_size)
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.lengths = np.zeros(size, dtype=np.int64)
        added = self.tok.get_added_tokens_decoder()
        for piece, i in self.tok.get_vocab(with_added_tokens=True).items():
            self.lengths[i] = len(added[i].content.encode()) if i in added else len(piece)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[bytes]) -> None:
        put, plain, odd = self.memo.put, [], []
        for c in chunks:
            (plain if _JOINABLE.fullmatch(c) else odd).append(c)
        put(zip(odd, self._whole([c.decode() for c in odd]), strict=True))
        # plain chunks in rows of about 64 kB: one library call each, cut by the tokens' byte lengths
        for s in range(0, len(plain), 8000):
            part = plain[s : s + 8000]
            ids = np.array(self.tok.encode_batch_fast([b"".join(part).decode()], add_special_tokens=False)[0].ids,
                           dtype="<u4")
            ends = np.cumsum(self.lengths[ids])
            want = np.cumsum([len(c) for c in part])
            cut = np.searchsorted(ends, want) + 1
            if not len(ids) or not np.array_equal(ends[np.minimum(cut, len(ends)) - 1], want):
                put(zip(part, self._whole([c.decode() for c in part]), strict=True))  # encode each
                continue
            raw, to = ids.tobytes(), (cut * 4).tolist()
            put((chunk, raw[a:b]) for chunk, a, b in zip(part, [0, *to[:-1]], to, strict=True))

    def _joined(self, raw: list[bytes]) -> list[np.ndarray]:
        """Ids of texts without other white space, none of them empty."""
        joined = b"".join(raw)
        data = np.frombuffer(joined, dtype=np.uint8)
        ends_of_texts = np.cumsum([len(r) for r in raw])
        space = _SPACE[data]
        begin = np.zeros(len(data), dtype=bool)
        letter = _LETTER[data]
        letter[1:] |= _LATIN[data[1:]] & (data[:-1] == 0xC3)
        begin[1:] = (space[1:] & ~space[:-1]) | (_MARK[data[1:]] & letter[:-1])
        begin[0] = True
        begin[ends_of_texts[:-1]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(data))
        hashes, second = (block_hashes(data, starts, ends, base) for base in BYTE_BASES)
        _, rep, place = np.unique(hashes, return_index=True, return_inverse=True)
        if not np.array_equal(second, second[rep][place]):  # two chunks with one hash: no table for this slice
            return [np.frombuffer(b, dtype="<u4") for b in self._whole([r.decode() for r in raw])]
        keys = [joined[a:b] for a, b in zip(starts[rep].tolist(), ends[rep].tolist(), strict=True)]
        young = self.memo.young
        found = list(map(young.get, keys))
        unknown = [i for i, ids in enumerate(found) if ids is None]
        if unknown:
            missing = self.memo.missing([[keys[i] for i in unknown]])
            self._learn(missing)
            for i in unknown:
                found[i] = young[keys[i]]
        self.memo.trim()
        ids = np.frombuffer(b"".join(found), dtype="<u4")
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) >> 2
        offsets = np.cumsum(sizes) - sizes
        own = sizes[place]
        out_ends = np.cumsum(own)
        out = ids[np.repeat(offsets[place] - out_ends + own, own) + np.arange(out_ends[-1])]
        cuts = out_ends[np.searchsorted(starts, ends_of_texts) - 1]
        return np.split(out, cuts[:-1])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers."""
        out: list = [np.zeros(0, dtype="<u4")] * len(texts)
        for a, b in slices(texts, 2_000_000):
            plain, odd = [], []
            for i in range(a, b):
                if texts[i]:
                    t = texts[i]
                    (odd if _OTHER_SPACE.search(t) or any(x in t for x in self.added) else plain).append(i)
            if plain:
                for i, ids in zip(plain, self._joined([texts[i].encode() for i in plain]), strict=True):
                    out[i] = ids
            for i, ids in zip(odd, self._whole([texts[i] for i in odd]), strict=True):
                out[i] = np.frombuffer(ids, dtype="<u4")
        return out


def _tokenizer(path: str) -> ByteTokenizer:
    return resident(("byte tokenizer", path), lambda: ByteTokenizer(path))


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = 0, segment_tokens: int = 131_072) -> None:
    """Encode every text, append ``end_id`` and write the store in ascending document order.

    One range shuffle of the texts by (id, hash of text) puts documents in order; a partition holds a
    bounded share of the rows whatever the ids are.  A document is never split between segments.
    """
    tokenizer = tokenizer or tokenizer_path("byte_bpe_50k.json")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part = _tokenizer(tokenizer), TaskContext.get().partitionId()
        names = [f.split()[0] for f in SEGMENT_SCHEMA.split(", ")]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        docs_in, blobs, held, start, number = [], [], 0, 0, 0
        end = np.array([end_id], dtype="<u4")

        def flush():
            nonlocal docs_in, blobs, held, start, number
            lengths = [len(b) + 1 for b in blobs]
            ids = np.concatenate([x for b in blobs for x in (b, end)])
            row = (part, number, start, held, docs_in[0], docs_in[-1], encode_segment(docs_in, lengths, ids))
            start, number, docs_in, blobs, held = start + held, number + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

        for batch in released(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(texts, 2_000_000):
                for doc, ids in zip(batch.column(0).slice(a, b - a).to_pylist(), tok.encode(texts[a:b]), strict=True):
                    docs_in.append(doc)
                    blobs.append(ids)
                    held += len(ids) + 1
                    if held >= segment_tokens:
                        yield flush()
        if docs_in:
            yield flush()

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(F.col(text_col)).alias("tie"))
    ordered = source.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "text").mapInArrow(segments, SEGMENT_SCHEMA).write.option("compression", "none").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a store: doc_id, start (tokens of all documents before it), n_tokens and
    ids_crc32, all computed from the files."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for part, start, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                doc_ids, ends, codes = decode_segment(blob)
                ids = codes.all().astype("<u4", copy=False)
                begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
                raw = memoryview(ids.tobytes())
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(doc_ids), pa.int32()), pa.array(doc_ids, pa.int64()),
                     pa.array(start + begins, pa.int64()), pa.array(ends - begins, pa.int64()),
                     pa.array(crcs, pa.int64())],
                    ["part", "doc_id", "part_start", "n_tokens", "ids_crc32"])

    store = spark.read.parquet(path)
    found = store.select("part", "part_start", "payload").mapInArrow(
        documents, "part int, doc_id long, part_start long, n_tokens long, ids_crc32 long")
    # one row per range partition: the running total of the partitions before it
    totals = store.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = totals.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("before"))
    return found.join(before, "part").select(
        "doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def read_token(spark: SparkSession, path: str, position: int) -> int | None:
    """Random access: the token at ``position`` of the whole store, None beyond its end.  Only the one
    segment that holds it is read (the offsets are pushed to the scan as filters)."""
    store = spark.read.parquet(path)
    at = position
    for row in store.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").toLocalIterator():
        if at < row["n"]:
            hit = store.where((F.col("part") == row["part"]) & (F.col("part_start") <= at)
                              & (F.col("part_start") + F.col("n_tokens") > at)).select("part_start", "payload").first()
            return decode_segment(bytes(hit["payload"]))[2][at - hit["part_start"]]
        at -= row["n"]
    return None
