"""Benchmark decontamination with one FM-index per training shard.

A shard is a run of whole texts. Its words become symbols: those of the test phrases
keep their identity, all others are one separator, as no phrase can cross them. The
FM-index over the symbols finds every test phrase by backward search in wavelet-tree
ranks, locates the hits by sampled suffix positions, and the hit ranges are merged to
removal spans. Nothing is shuffled.

The phrases reach the tasks by broadcast, in blocks of at most ``BLOCK_BYTES`` of
benchmark text. A larger benchmark takes several blocks, each its own pass over the
rows on their way, so what is broadcast does not grow with it.

Defined results: null, empty and wordless texts have no words and no hits. A null
benchmark text is no item; a null item id counts as the empty string. Items with the
same text are all reported. Documents may repeat; each row is judged by itself. An
empty benchmark hits nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfcast.llm.fmindex import FmIndex
from shelfcast.llm.textscan import (
    ALPHANUMERIC,
    LOWER,
    SHARD_BYTES,
    Words,
    bounded_batches,
    release_memory,
    shards,
    spread,
    utf8,
)

WINDOW = 10
BLOCK_BYTES = 4 * 1024**2

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = {upper: upper + 32 for upper in range(0x41, 0x5B)}

#: ``first`` and ``last`` count words, ``start`` and ``end`` code points; both ends are exclusive.
SPANS = "array<struct<first:int,last:int,start:int,end:int>>"


@dataclass
class Phrases:
    """One block of test phrases, ready to be searched for."""

    vocabulary_hash: np.ndarray  # ascending
    vocabulary_symbol: np.ndarray
    vocabulary_bytes: np.ndarray
    vocabulary_at: np.ndarray  # by symbol
    vocabulary_length: np.ndarray
    patterns: np.ndarray
    lengths: np.ndarray
    item_first: np.ndarray  # items of pattern i: item_of[item_first[i] : item_first[i + 1]]
    item_of: np.ndarray
    items: list[str]

    @property
    def shortest(self) -> int:
        return int(self.lengths.min()) if len(self.lengths) else 0


def phrases(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> Phrases:
    """All windows of the items; an item with fewer words is one window."""
    symbols: dict[str, int] = {}
    holders: dict[tuple[int, ...], set[int]] = {}
    names = sorted({"" if name is None else str(name) for name, _ in items})
    number = {name: i for i, name in enumerate(names)}
    for name, text in items:
        words = [
            symbols.setdefault(word, len(symbols) + 1)
            for word in _WORD.findall((text or "").translate(_FOLD))
        ]
        owner = number["" if name is None else str(name)]
        for start in range(max(1, len(words) - window + 1) if words else 0):
            holders.setdefault(tuple(words[start : start + window]), set()).add(owner)
    encoded = [word.encode() for word in symbols]
    lengths = np.array([0, *map(len, encoded)], np.int64)
    pool = np.frombuffer(b"".join(encoded), np.uint8)
    ends = np.cumsum(lengths)
    hashes = Words(pool, ends, np.ones(256, bool)).hashes()
    order = np.argsort(hashes)
    patterns = np.zeros((len(holders), window), np.int64)
    for row, pattern in enumerate(holders):
        patterns[row, window - len(pattern) :] = pattern
    return Phrases(
        vocabulary_hash=hashes[order],
        vocabulary_symbol=order + 1,
        vocabulary_bytes=pool,
        vocabulary_at=ends - lengths,
        vocabulary_length=lengths,
        patterns=patterns,
        lengths=np.array([len(pattern) for pattern in holders], np.int64),
        item_first=np.cumsum([0, *(len(owners) for owners in holders.values())]),
        item_of=np.array([o for owners in holders.values() for o in sorted(owners)], np.int64),
        items=names,
    )


def _symbols(words: Words, block: Phrases) -> np.ndarray:
    """Each word's symbol, or 0. A hash only proposes; the bytes decide."""
    hashes = words.hashes()
    place = np.searchsorted(block.vocabulary_hash, hashes)
    place[place == len(block.vocabulary_hash)] = 0
    which = np.flatnonzero(block.vocabulary_hash[place] == hashes)
    symbol = block.vocabulary_symbol[place[which]]
    equal = words.same(
        which,
        block.vocabulary_bytes,
        block.vocabulary_at[symbol],
        block.vocabulary_length[symbol],
    )
    found = np.zeros(len(words), np.int64)
    found[which[equal]] = symbol[equal]
    return found


def _runs(words: Words, symbol: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all runs that can hold a phrase, each closed by a separator; their words.

    A run ends at a foreign word and at the end of a text.
    """
    known = symbol > 0
    head = np.zeros(len(words) + 1, bool)
    head[words.first] = True
    first = np.flatnonzero(known & (head[:-1] | ~np.concatenate([[False], known[:-1]])))
    last = np.flatnonzero(known & (head[1:] | ~np.concatenate([known[1:], [False]]))) + 1
    size = last - first
    first, size = first[size >= shortest], size[size >= shortest]
    at, place = spread(first, size + 1)
    closing = place == np.repeat(size, size + 1)
    sequence = np.where(closing, 0, symbol[np.minimum(at, len(symbol) - 1)])
    return sequence, at


def _merge(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of overlapping or touching ranges, in order."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    opens = np.ones(len(first), bool)
    opens[1:] = first[1:] > last[:-1]
    closes = np.roll(opens, -1)
    return first[opens], last[closes]


@dataclass
class Hits:
    """Of some texts: word counts, merged hit ranges in bytes, and the items found."""

    words: np.ndarray
    hit: np.ndarray
    row: np.ndarray  # of each span
    first: np.ndarray
    last: np.ndarray
    start: np.ndarray
    end: np.ndarray
    item_row: np.ndarray
    item: np.ndarray


def search_shard(data: np.ndarray, offsets: np.ndarray, block: Phrases) -> Hits:
    words = Words(LOWER[data], offsets, ALPHANUMERIC)
    none = np.zeros(0, np.int64)
    hits = Hits(words.counts, np.zeros(len(words.counts), np.int64), *[none] * 7)
    if not len(words) or not len(block.lengths):
        return hits
    sequence, word_of = _runs(words, _symbols(words, block), block.shortest)
    if not len(sequence):
        return hits
    index = FmIndex(sequence, len(block.vocabulary_symbol))
    low, high = index.search(block.patterns, block.lengths)
    found = np.flatnonzero(high > low)
    rows, _ = spread(low[found], high[found] - low[found])
    pattern = np.repeat(found, high[found] - low[found])
    first = word_of[index.locate(rows)]
    last = first + block.lengths[pattern]
    # texts don't share words, so ranges of two texts may touch but must not be joined
    text = np.searchsorted(words.first, first, side="right") - 1
    start, end = _merge(first + text, last + text)
    row = np.searchsorted(words.first + np.arange(len(words.first)), start, side="right") - 1
    start, end = start - row, end - row
    np.add.at(hits.hit, row, end - start)
    hits.row, hits.start, hits.end = row, words.starts[start], words.ends[end - 1]
    hits.first, hits.last = start - words.first[row], end - words.first[row]
    owned = block.item_first[pattern + 1] - block.item_first[pattern]
    place, _ = spread(block.item_first[pattern], owned)
    pair = np.unique(np.repeat(text, owned) * len(block.items) + block.item_of[place])
    hits.item_row, hits.item = pair // len(block.items), pair % len(block.items)
    return hits


def _list(values: pa.Array, row: np.ndarray, rows: int) -> pa.Array:
    ends = np.cumsum(np.bincount(row, minlength=rows))
    return pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), values)


def _report(batch: pa.RecordBatch, text: str, broadcast) -> Iterator[pa.RecordBatch]:
    block: Phrases = broadcast.value
    data, offsets = utf8(batch.column(text))
    for low, high in shards(offsets):
        part = data[offsets[low] : offsets[high]]
        hits = search_shard(part, offsets[low : high + 1] - offsets[low], block)
        begins = np.zeros(len(part) + 1, np.int64)
        if len(hits.row):
            np.cumsum((part & 0xC0) != 0x80, out=begins[1:])
        base = begins[offsets[low:high] - offsets[low]][hits.row]
        spans = pa.StructArray.from_arrays(
            [
                pa.array(values, pa.int32())
                for values in (
                    hits.first,
                    hits.last,
                    begins[hits.start] - base,
                    begins[hits.end] - base,
                )
            ],
            ["first", "last", "start", "end"],
        )
        names = pa.array(block.items, pa.string()).take(pa.array(hits.item))
        rows = high - low
        yield pa.RecordBatch.from_arrays(
            [
                *batch.slice(low, rows).columns,
                pa.array(hits.words, pa.int64()),
                _list(spans, hits.row, rows),
                _list(names, hits.item_row, rows),
            ],
            [*batch.schema.names, "_words", "_spans", "_items"],
        )


def blocks(benchmark: DataFrame, id_column: str, text: str, block_bytes: int) -> list[Phrases]:
    """The benchmark on the driver, at most ``block_bytes`` at a time (or one item)."""
    items = benchmark.select(F.col(id_column).cast("string"), F.col(text).cast("string"))
    items = items.toDF("id", "text").where(F.col("text").isNotNull())
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = max(1, math.ceil(size / block_bytes))
    bucket = F.pmod(F.xxhash64("id"), F.lit(count))
    for number in range(count):
        part = items.where(bucket == number) if count > 1 else items
        yield phrases([tuple(row) for row in part.collect()])


def _spans_union(left: str, right: str) -> Column:
    """Two columns of spans as one column of merged spans."""

    def grow(done: Column, span: Column) -> Column:
        top = F.element_at(done, -1)
        joined = F.struct(
            top["first"].alias("first"),
            F.greatest(top["last"], span["last"]).alias("last"),
            top["start"].alias("start"),
            F.greatest(top["end"], span["end"]).alias("end"),
        )
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["last"] >= span["first"])
        shorter = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(touches, F.concat(shorter, F.array(joined))).otherwise(
            F.concat(done, F.array(span))
        )

    grown = F.aggregate(
        F.array_sort(F.concat(left, right)), F.expr(f"cast(array() as {SPANS})"), grow
    )
    return F.when(F.size(right) == 0, F.col(left)).otherwise(grown)


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``_words`` (how many), ``_spans`` (merged) and ``_items`` (found, sorted)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    out = docs.drop("_words", "_spans", "_items")
    plain, found = out.columns, []
    # parts of the result go by names that no column of ``docs`` begins with
    prefix = "_found"
    while any(name.lower().startswith(prefix) for name in plain):
        prefix += "_"
    for number, block in enumerate(blocks(benchmark, item_id, item_text, block_bytes)):
        broadcast = spark.sparkContext.broadcast(block)
        schema = _with(out, f"_words long, _spans {SPANS}, _items array<string>")

        def scan(batches, broadcast=broadcast):
            for batch in batches:
                yield from _report(batch, text, broadcast)
            release_memory()

        names = {f"_{part}": f"{prefix}_{part}{number}" for part in ("words", "spans", "items")}
        out = out.mapInArrow(scan, schema).withColumnsRenamed(names)
        found.append(number)
    last = found[-1]
    for number in found[:-1]:
        spans = [f"{prefix}_spans{one}" for one in (last, number)]
        out = out.withColumn(spans[0], _spans_union(*spans))
    items = reduce(F.array_union, [F.col(f"{prefix}_items{number}") for number in found])
    return out.select(
        *plain,
        F.col(f"{prefix}_words{last}").alias("_words"),
        F.col(f"{prefix}_spans{last}").alias("_spans"),
        F.array_sort(items).alias("_items"),
    )


def _with(df: DataFrame, columns: str) -> StructType:
    return StructType([*df.schema, *StructType.fromDDL(columns)])


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with every benchmark passage cut out of its text.

    Where something is cut, a line break stands for it, ``n_chars`` (if there is such a
    column) is counted anew, and a text without a word left goes altogether. The other
    rows stay as they are.
    """
    # columns of the names that are used below step aside
    aside = {name: f"own{name}" for name in ("_words", "_spans", "_items", "_cut")}
    found = find(docs.withColumnsRenamed(aside), benchmark, text, **options)
    hit = F.size("_spans") > 0
    starts = F.concat(F.array(F.lit(0)), F.col("_spans.end"))
    ends = F.concat(F.col("_spans.start"), F.array(F.char_length(text)))
    kept = F.zip_with(starts, ends, lambda a, b: F.substring(F.col(text), a + 1, b - a))
    cut = found.withColumn("_cut", F.when(hit, F.array_join(kept, "\n")))
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    cut = cut.where(~hit | F.col("_cut").rlike(word))
    renewed = {text: F.coalesce("_cut", text)}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        fresh = F.char_length("_cut").cast(kind)
        renewed["n_chars"] = F.when(hit, fresh).otherwise(F.col("n_chars"))
    own = {name: F.col(aside.get(name, name)) for name in docs.columns}
    return cut.select(*[renewed.get(name, own[name]).alias(name) for name in docs.columns])
