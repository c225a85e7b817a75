"""Token ids of a corpus in bit-plane files.

Encoding: a text is cut where the tokenizer cuts it anyway, each distinct piece of a
shard is encoded once by the tokenizers library, and the ids are put together again. That
holds for tokenizers that fold and cut texts in one way (``cuts_alike``); with any other, whole
texts are encoded.

File format: a folder of Parquet files, written and committed by Spark, so it lives on
any store Spark writes to and survives lost executors. Files follow each other by
``part``. A row is a segment of whole texts:

- ``part``, ``segment``, ``start``: the file, the segment in it, and ids before it there
- ``doc_ids``, ``n_tokens``: its texts in ascending order and how many ids each has
- ``mode``, ``width``: ``bit`` or ``byte`` planes, and the bytes an id takes
- ``index``: per block and plane, the length of the compressed plane
- ``planes``: all compressed planes, block by block

A block holds ``BLOCK_IDS`` ids of the segment (the last block the rest). Its planes
are the transposed bytes, or bits, of its little-endian ids, each compressed with
zstandard. The index gives any block without reading the others.

Defined results: a null text is empty and has the end id alone. Rows with a null id
come first; rows with the same id are all kept, one after the other.
"""

from __future__ import annotations

import json
import math
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm.textscan import (
    LOWER,
    Words,
    bounded_batches,
    byte_class,
    indices,
    release_memory,
    shards,
    utf8,
)
from shelfcast.session import fresh_path

END_ID = 1
BLOCK_IDS = 1 << 16
SEGMENT_IDS = 1 << 19
PART_BYTES = 24 * 1024**2
#: Of a larger corpus the parts grow; a part is sorted by Spark and written in segments.
MAX_PARTS = 20_000
#: Texts are cut and encoded by this many bytes at a time.
SHARD_BYTES = 1 << 19
#: What a worker may remember of pieces and their ids, and how many new ones it encodes at once.
CACHED_BYTES = 32 * 1024**2
FRESH_PIECES = 4096
#: So many new pieces go to the tokenizer as one text, each with a mark of one id behind it.
JOINED_PIECES = 64
MARK = "\x01"
#: Row groups of the files: a row is a segment of a megabyte or so.
ROW_GROUP_BYTES = 16 * 1024**2

SEGMENT = (
    "part int, segment int, start long, doc_ids array<long>, n_tokens array<long>, "
    "mode string, width int, index array<int>, planes binary"
)

# --- planes -------------------------------------------------------------------------


def pack(ids: np.ndarray, width: int, mode: str) -> tuple[list[int], bytes]:
    """Blocks of ids as compressed planes: the planes' lengths, and the planes."""
    packer, index, planes = zstandard.ZstdCompressor(level=3), [], []
    for low in range(0, len(ids), BLOCK_IDS):
        block = ids[low : low + BLOCK_IDS].astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]
        if mode == "bit":
            bits = np.unpackbits(block, axis=1, bitorder="little")
            block = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
        else:
            block = np.ascontiguousarray(block.T)
        for plane in block:
            planes.append(packer.compress(plane.tobytes()))
            index.append(len(planes[-1]))
    return index, b"".join(planes)


def unpack(index: list[int], planes: bytes, count: int, width: int, mode: str) -> np.ndarray:
    """The ids that ``pack`` was given."""
    reader, ids = zstandard.ZstdDecompressor(), np.zeros((count, 4), np.uint8)
    per_block, at = width * (8 if mode == "bit" else 1), 0
    for number, low in enumerate(range(0, count, BLOCK_IDS)):
        size = min(BLOCK_IDS, count - low)
        rows = []
        for length in index[number * per_block : (number + 1) * per_block]:
            plane = reader.decompress(planes[at : at + length])
            rows.append(np.frombuffer(plane, np.uint8))
            at += length
        block = np.stack(rows)
        if mode == "bit":
            bits = np.unpackbits(block, axis=1, bitorder="little")[:, :size]
            block = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").T
        ids[low : low + size, :width] = block.T
    return ids.view("<u4").ravel()


# --- pieces of text -----------------------------------------------------------------

_BLANK = byte_class(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
_LETTER = byte_class(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
_DIGIT = byte_class(lambda b: 0x30 <= b <= 0x39)
# not the marks that contractions and special tokens are made of
_MARK = byte_class(lambda b: chr(b) in '!"#$%&()*+,-./:;=?@[\\]^_`{}~')
#: What ASCII bytes are: 1 letters, 2 digits, 3 marks.
_KIND = (_LETTER + 2 * _DIGIT.astype(np.int8) + 3 * _MARK.astype(np.int8)).astype(np.int8)


def pieces(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Cuts at blanks, and inside plain chunks between letters, single digits and marks.

    Plain are chunks of ASCII letters, digits and marks and of the letters from U+00C0 to
    U+00FF. There the tokenizer cuts at the same places, and as it lower-cases, so do the
    letters here. Any other chunk stays whole.
    """
    nothing = np.zeros(len(data), bool)
    following, before = nothing.copy(), nothing.copy()
    latin = (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7)
    lead = data == 0xC3
    following[:-1] = latin[1:]
    lead &= following
    before[1:] = lead[:-1]
    kind = _KIND[data]
    kind[lead | (latin & before)] = 1
    chunks = Words(data, offsets, ~_BLANK)
    if not len(chunks):
        return chunks
    odd = (kind == 0) & ~_BLANK[data]
    if odd.any():
        count = np.concatenate([[0], np.cumsum(odd)])
        whole = np.flatnonzero(count[chunks.ends] > count[chunks.starts])
        kind[indices(chunks.starts[whole], chunks.lengths[whole])] = 4
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    edge[offsets] = True
    inside = kind > 0
    starts = np.flatnonzero(edge[:-1] & inside)
    ends = np.flatnonzero(edge[1:] & inside) + 1
    return Words.at(np.where(kind == 1, LOWER[data], data), offsets, starts, ends)


#: How a tokenizer must fold texts and cut them for ``pieces`` to cut alike.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts_alike(path: str) -> bool:
    """Whether the tokenizer of a file folds and cuts texts as ``pieces`` does."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    normalizers = (told.get("normalizer") or {}).get("normalizers") or []
    splits = (told.get("pre_tokenizer") or {}).get("pretokenizers") or []
    replaced = [one.get("pattern") for one in normalizers if one.get("type") == "Replace"]
    return (
        [one.get("type") for one in normalizers] == _NORMALIZERS
        and replaced == [{"Regex": r"\s+"}]
        and [one.get("type") for one in splits] == ["Split", "ByteLevel"]
        and splits[0].get("pattern") == {"Regex": _SPLIT}
        and (splits[0].get("behavior"), splits[0].get("invert")) == ("Removed", True)
    )


class Encoder:
    """Ids of texts; remembers up to ``CACHED_BYTES`` of pieces from one shard to the next."""

    def __init__(self, path: str):
        self.tokenizer, self.by_piece = Tokenizer.from_file(path), cuts_alike(path)
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.forget()

    def forget(self) -> None:
        self.hash = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.text, self.text_at = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.ids_at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for low in range(0, len(texts), FRESH_PIECES):
            some = texts[low : low + FRESH_PIECES]
            found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            lists = [one.ids for one in found]
            counts.append(np.array([*map(len, lists)], np.int64))
            ids.append(np.fromiter(chain.from_iterable(lists), np.uint32, int(counts[-1].sum())))
        return np.concatenate(ids), np.concatenate(counts)

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``_library`` of pieces, in fewer and longer texts.

        Blanks and marks are cut from pieces, so these have the ids that they have alone. Pieces
        that hold a mark themselves show by the number of marks, and are encoded one by one.
        """
        if len(self.mark) != 1:
            return self._library(texts)
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for low in range(0, len(texts), FRESH_PIECES):
            some = texts[low : low + FRESH_PIECES]
            groups = [some[at : at + JOINED_PIECES] for at in range(0, len(some), JOINED_PIECES)]
            joined = [f" {MARK} ".join([*group, ""]) for group in groups]
            found, sizes = self._library(joined)
            marks = found == self.mark[0]
            before = np.concatenate([[0], np.cumsum(marks)])[np.cumsum(sizes)]
            if (before == np.cumsum([*map(len, groups)])).all():
                counts.append(np.diff(np.flatnonzero(marks), prepend=-1) - 1)
                ids.append(found[~marks])
            else:
                apart, each = self._library(some)
                ids.append(apart)
                counts.append(each)
        return np.concatenate(ids), np.concatenate(counts)

    @property
    def held(self) -> int:
        """Bytes that are remembered."""
        parts = (self.hash, self.place, self.text, self.text_at, self.ids, self.ids_at)
        return sum(part.nbytes for part in parts)

    def _learn(self, words: Words, hashes: np.ndarray, which: np.ndarray) -> None:
        raw = words.data.tobytes()
        ranges = zip(words.starts[which].tolist(), words.ends[which].tolist())
        fresh = [raw[a:b] for a, b in ranges]
        ids, counts = self._pieces([one.decode("utf-8", "replace") for one in fresh])
        known = len(self.text_at) - 1
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(fresh), np.uint8)])
        self.text_at = np.append(self.text_at, self.text_at[-1] + np.cumsum([*map(len, fresh)]))
        self.ids = np.concatenate([self.ids, ids])
        self.ids_at = np.append(self.ids_at, self.ids_at[-1] + np.cumsum(counts))
        joined = np.concatenate([self.hash, hashes[which]])
        order = np.argsort(joined, kind="stable")
        self.hash = joined[order]
        self.place = np.concatenate([self.place, np.arange(known, known + len(which))])[order]

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.hash, hashes)
        at[at == len(self.hash)] = 0
        found = self.hash[at] == hashes if len(self.hash) else np.zeros(len(hashes), bool)
        return at, found

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int | None):
        """Ids of all texts one after the other, and how many each has, ``end`` included."""
        if not self.by_piece:
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])]
            ids, counts = self._library(texts)
            if end is None:
                return ids, counts
            return np.insert(ids, np.cumsum(counts), np.uint32(end)), counts + 1
        words = pieces(data, offsets)
        hashes, text = words.hashed()
        distinct, sample, number = np.unique(hashes, return_index=True, return_inverse=True)
        _, found = self._find(distinct)
        if not found.all():
            if self.held > CACHED_BYTES:
                self.forget()
                found[:] = False
            self._learn(words, hashes, sample[~found])
        at, _ = self._find(distinct)
        place = self.place[at][number] if len(words) else np.zeros(0, np.int64)
        sizes = self.text_at[place + 1] - self.text_at[place]
        equal = words.all_same(text, self.text, self.text_at[place], sizes)
        starts, counts = self.ids_at[place], self.ids_at[place + 1] - self.ids_at[place]
        pool = self.ids
        if not equal.all():  # two pieces of one hash: encode these as they are
            raw = words.data.tobytes()
            odd = np.flatnonzero(~equal)
            apart, counts[odd] = self._library(
                [raw[words.starts[i] : words.ends[i]].decode("utf-8", "replace") for i in odd]
            )
            starts[odd] = len(pool) + np.cumsum(counts[odd]) - counts[odd]
            pool = np.concatenate([pool, apart])
        if end is not None:
            starts = np.insert(starts, words.first[1:], len(pool))
            counts = np.insert(counts, words.first[1:], 1)
            pool = np.append(pool, np.uint32(end))
            first = words.first + np.arange(len(words.first))
        else:
            first = words.first
        taken = indices(starts, counts)
        before = np.concatenate([[0], np.cumsum(counts)])[first]
        return pool[taken], np.diff(before)


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One for all tasks of a worker: the library does not give all of its memory back."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are what runs side by side
    return Encoder(path)


# --- writing and reading ------------------------------------------------------------


def _bounds(docs: DataFrame, doc_id: str, text: str, part_bytes: int) -> np.ndarray:
    """Ids that cut the corpus into parts of about ``part_bytes`` of text."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    count = min(max(1, math.ceil(size / part_bytes)), MAX_PARTS)
    if count == 1:
        return np.zeros(0, np.int64)
    shares = [number / count for number in range(1, count)]
    cuts = docs.agg(F.percentile_approx(doc_id, shares, 20 * count)).first()[0] or []
    return np.unique(np.array(cuts, np.int64))


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end: int | None = END_ID,
    mode: str = "byte",
    part_bytes: int = PART_BYTES,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode all texts and write them in ascending order of their whole-number ids."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    bounds = _bounds(docs, "doc_id", "text", part_bytes)
    widest = max(Tokenizer.from_file(tokenizer).get_vocab_size(True) - 1, end or 0, 1)
    width = (widest.bit_length() + 7) // 8

    def encode(batches):
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for low, high in shards(offsets, SHARD_BYTES):
                part = data[offsets[low] : offsets[high]]
                ids, counts = _encoder(tokenizer).encode(
                    part, offsets[low : high + 1] - offsets[low], end
                )
                packed = np.ascontiguousarray(ids.view(np.uint8).reshape(-1, 4)[:, :width])
                ends = np.concatenate([[0], np.cumsum(counts)]) * width
                names = batch.column("doc_id").slice(low, high - low)
                numbers = names.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        names,
                        pa.array(np.searchsorted(bounds, numbers), pa.int32()),
                        pa.Array.from_buffers(
                            pa.binary(),
                            high - low,
                            [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(packed)],
                        ),
                    ],
                    ["doc_id", "part", "ids"],
                )
        release_memory()

    def segments(batches):
        segment, start, part, held, names = 0, 0, 0, [], []

        def flush():
            nonlocal segment, start, held, names
            counts = [len(one) // width for one in held]
            ids = np.zeros((sum(counts), 4), np.uint8)
            ids[:, :width] = np.frombuffer(b"".join(held), np.uint8).reshape(-1, width)
            index, planes = pack(ids.view("<u4").ravel(), width, mode)
            row = dict(part=part, segment=segment, start=start, doc_ids=names, n_tokens=counts)
            row |= dict(mode=mode, width=width, index=index, planes=planes)
            segment, start, held, names = segment + 1, start + len(ids), [], []
            return pa.RecordBatch.from_pylist([row], schema=_SEGMENT)

        size = 0
        for batch in batches:
            for name, part_of, ids in zip(*(column for column in batch.columns)):
                if held and size + len(ids.as_buffer()) > segment_ids * width:
                    yield flush()
                    size = 0
                part = part_of.as_py()
                held.append(ids.as_py())
                names.append(name.as_py())
                size += len(held[-1])
        if held:
            yield flush()
        release_memory()

    encoded = docs.mapInArrow(encode, "doc_id long, part int, ids binary")
    parts = encoded.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("doc_id")
    writer = parts.mapInArrow(segments, SEGMENT).write
    writer.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path, compression="none")


_SEGMENT = pa.schema(
    [
        ("part", pa.int32()),
        ("segment", pa.int32()),
        ("start", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("mode", pa.string()),
        ("width", pa.int32()),
        ("index", pa.list_(pa.int32())),
        ("planes", pa.binary()),
    ]
)


def _parts(spark: SparkSession, path: str) -> dict[int, int]:
    """Ids before each part. One small row per file reaches the driver."""
    sizes = (
        spark.read.parquet(path)
        .groupBy("part")
        .agg(F.sum(F.expr("aggregate(n_tokens, 0L, (a, n) -> a + n)")).alias("n"))
        .collect()
    )
    before, total = {}, 0
    for row in sorted(sizes, key=lambda row: row.part):
        before[row.part] = total
        total += row.n
    return before


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per text: ``doc_id, start, n_tokens, ids`` (little-endian 32-bit numbers)."""
    before = _parts(spark, path)

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["n_tokens"], np.int64)
                total = int(counts.sum())
                ids = unpack(row["index"], row["planes"], total, row["width"], row["mode"])
                ends = np.concatenate([[0], np.cumsum(counts)])
                base = before[row["part"]] + row["start"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(base + ends[:-1], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.Array.from_buffers(
                            pa.binary(),
                            len(counts),
                            [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(ids)],
                        ),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )
        release_memory()

    segments = spark.read.parquet(path).select(
        "part", "start", "doc_ids", "n_tokens", "mode", "width", "index", "planes"
    )
    return segments.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def digests(texts: DataFrame) -> DataFrame:
    """``read``'s rows with the unsigned CRC-32 of the ids instead of the ids."""
    return texts.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def fresh_folder(spark: SparkSession) -> str:
    return fresh_path(spark, "token-planes")


