"""How quality filters interact, in every order that they could be applied in.

A document fails some of the filters; which ones is its mask. What then happens to it at
each step of each order follows from the mask alone, so there is one big integer per mask
with a field for each outcome of each step, 1 where it happens. The sum of the documents'
integers has the counts in its fields. ``FIELD_BYTES`` holds more than 10**14 documents,
which is checked before fields are read, so no field runs over into the next.

Sums are taken per part of the corpus in the tasks, merged per part and salt, and then per
part. A task holds at most ``MAX_HELD`` sums, whatever the number of parts.

Of copies, all but those with the smallest id fail filter E. First ids are found by partial
minima per text hash (128 bits). Texts that over a thousandth of all rows share, fewer than a
thousand texts, are looked up by broadcast, the others by a shuffle that no text dominates.

Defined results: a null text is empty, and equal to other empty ones. A null part is the
empty string. A null id is no smaller id and has none. Rows may repeat, each is counted, and
rows of one id are not copies of each other. Labels that are null are ignored; if an id has
several, it is good or toxic where any says so. Without documents there are no rows.
"""

from __future__ import annotations

import hashlib
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import stage

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITAL_PERCENT = 10
OUTCOMES = ("kept", "removed", "redundant")
FIELD_BYTES = 6
MAX_HELD = 512
#: Partial sums of a part are merged under so many salts first.
SALTS = 64
#: A text that more than one of so many rows share is looked up by broadcast.
HOT_SHARE = 1000
#: Long texts are cut into words by about so many bytes at a time.
CHUNK_BYTES = 1 << 20

_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_CAPITALS = bytes(range(0x41, 0x5B))
_NOT_FIRST = bytes(range(0x80, 0xC0))
_MARKS = b"#$%&*|"

MARKED = "doc_id long, part string, mask int, text_hash binary"
SUMS = "part string, salt int, rows long, outcomes binary, good binary, toxic binary"
AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


# --- what a document fails ------------------------------------------------------------


def _word_counts(raw: bytes) -> tuple[int, int]:
    """Words, and distinct words. ``bytes.split`` cuts at blanks and the characters 9 to 13."""
    words, distinct, at = 0, set(), 0
    while at < len(raw):
        blank = _BLANK.search(raw, at + CHUNK_BYTES)
        upto = blank.end() if blank else len(raw)
        some = raw[at:upto].split()
        words += len(some)
        distinct.update(some)
        at = upto
    return words, len(distinct)


def failing(raw: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words, distinct = _word_counts(raw)
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    points = len(raw.translate(None, _NOT_FIRST))
    return (
        (words < MIN_WORDS)
        | (100 * distinct < MIN_DISTINCT_PERCENT * words) << 1
        | (100 * capitals > MAX_CAPITAL_PERCENT * points) << 2
        | (len(raw.translate(None, _MARKS)) < len(raw)) << 3
    )


def _mark(batches):
    for batch in batches:
        masks, hashes = [], []
        for value in batch.column("text"):
            raw = value.as_py() or b""
            masks.append(failing(raw))
            hashes.append(hashlib.blake2b(raw, digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("part"),
                pa.array(masks, pa.int32()),
                pa.array(hashes, pa.binary()),
            ],
            ["doc_id", "part", "mask", "text_hash"],
        )


def _copies(marked: DataFrame) -> DataFrame:
    """``marked`` with the bit of filter E set where a smaller id has the same text."""
    total = marked.count()
    shared = marked.groupBy("text_hash").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n")
    )
    shared = stage(shared.where("n > 1"), "shared-texts")
    hot = F.col("n") > total / HOT_SHARE
    often = F.broadcast(shared.where(hot).select("text_hash", "first", "n"))
    seldom = shared.where(~hot).select("text_hash", "first")
    looked_up = marked.join(often, "text_hash", "left")
    rest = looked_up.where("n is null").drop("first", "n").join(seldom, "text_hash", "left")
    both = looked_up.where("n is not null").drop("n").unionByName(rest)
    copied = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return both.withColumn("mask", F.col("mask") + F.when(copied, 16).otherwise(0))


def marks(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """``doc_id, part, mask, good, toxic``: the filters that each document fails, as bits."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(text).cast("binary").alias("text"),
    )
    marked = stage(rows.mapInArrow(_mark, MARKED), "marked")
    told = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.col("quality") == 1).alias("good"),
        (F.col("toxic") == 1).alias("toxic"),
    )
    told = told.where("doc_id is not null and (good or toxic)").groupBy("doc_id")
    told = told.agg(F.coalesce(F.bool_or("good"), F.lit(False)).alias("good"),
                    F.coalesce(F.bool_or("toxic"), F.lit(False)).alias("toxic"))
    joined = _copies(marked).join(told, "doc_id", "left")
    return joined.fillna(False, ["good", "toxic"]).select("doc_id", "part", "mask", "good", "toxic")


# --- packed counters ------------------------------------------------------------------


def orders(filters: str = FILTERS) -> list[str]:
    return ["".join(order) for order in permutations(filters)]


def outcomes(mask: int, filters: str = FILTERS) -> tuple[int, int]:
    """The integer of a mask: fields by outcome, order and step; and that of removals alone."""
    bit = {name: 1 << place for place, name in enumerate(filters)}
    steps = [(order, step) for order in orders(filters) for step in range(len(filters))]
    happened = np.zeros((len(OUTCOMES), len(steps), FIELD_BYTES), np.uint8)
    for place, (order, step) in enumerate(steps):
        gone = any(mask & bit[name] for name in order[:step])
        fails = bool(mask & bit[order[step]])
        if not (gone and not fails):
            happened[(2 if gone else 1) if fails else 0, place, 0] = 1
    packed = (happened.tobytes(), happened[1].tobytes())
    return tuple(int.from_bytes(raw, "little") for raw in packed)


def fields(value: int, rows: int, count: int) -> np.ndarray:
    """The ``count`` fields of a sum over ``rows`` documents."""
    if rows >= 1 << (8 * FIELD_BYTES):
        raise OverflowError(f"{rows} documents do not fit into a field of {FIELD_BYTES} bytes")
    raw = np.frombuffer(value.to_bytes(count * FIELD_BYTES, "little"), np.uint8)
    wide = np.zeros((count, 8), np.uint8)
    wide[:, :FIELD_BYTES] = raw.reshape(-1, FIELD_BYTES)
    return wide.view("<i8").ravel()


def _as_bytes(value: int) -> bytes:
    return value.to_bytes((value.bit_length() + 7) // 8, "little")


def _sum_batch(sums: dict) -> pa.RecordBatch:
    rows = [(*key, held[0], *map(_as_bytes, held[1:])) for key, held in sums.items()]
    columns = zip(*rows) if rows else [()] * 6
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = ["part", "salt", "rows", "outcomes", "good", "toxic"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _sums(filters: str):
    def run(batches):
        table = [outcomes(mask, filters) for mask in range(1 << len(filters))]
        sums: dict = {}
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in
                       ("part", "salt", "mask", "good", "toxic")]
            for part, salt, mask, good, toxic in zip(*columns):
                if (part, salt) not in sums:
                    if len(sums) >= MAX_HELD:
                        yield _sum_batch(sums)
                        sums = {}
                    sums[part, salt] = [0, 0, 0, 0]
                held = sums[part, salt]
                every, removed = table[mask]
                held[0] += 1
                held[1] += every
                if good:
                    held[2] += removed
                if toxic:
                    held[3] += removed
        yield _sum_batch(sums)

    return run


def _runs(batches):
    """``key, sums`` of each run of rows with the same part and salt."""
    key, held = None, None
    for batch in batches:
        for part, salt, rows, *packed in zip(*(column.to_pylist() for column in batch.columns)):
            if key != (part, salt):
                if key is not None:
                    yield key, held
                key, held = (part, salt), [0, 0, 0, 0]
            held[0] += rows
            for place, raw in enumerate(packed, 1):
                held[place] += int.from_bytes(raw, "little")
    if key is not None:
        yield key, held


def _merge(batches):
    for key, held in _runs(batches):
        yield _sum_batch({key: held})


def _unpack(filters: str):
    every = orders(filters)
    names = [name for order in every for name in order]

    def run(batches):
        for (part, _), (rows, *packed) in _runs(batches):
            steps = len(names)
            kept, removed, redundant = fields(packed[0], rows, 3 * steps).reshape(3, steps)
            good, toxic = (fields(one, rows, steps) for one in packed[1:])
            last = {order[-1]: (number + 1) * len(filters) - 1 for number, order in enumerate(every)}
            only = [int(removed[last[name]]) for name in names]
            over_orders = {
                name: sum(int(n) for n, own in zip(removed, names) if own == name)
                for name in filters
            }
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * steps, pa.string()),
                    pa.array([order for order in every for _ in order], pa.string()),
                    pa.array([*range(1, len(filters) + 1)] * len(every), pa.int32()),
                    *(pa.array(column, pa.int64()) for column in (kept, removed, redundant)),
                    pa.array(only, pa.int64()),
                    pa.array(good, pa.int64()),
                    pa.array(toxic, pa.int64()),
                    pa.array([over_orders[name] for name in names], pa.int64()),
                ],
                [field.split()[0] for field in AUDIT.split(", ")],
            )

    return run


def audit(marked: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from rows as ``marks`` makes them.

    ``kept`` are left after the step, ``removed`` go at it, ``redundant`` fail its filter but
    went before. ``unique_fails`` fail its filter alone: those that it removes as the last.
    ``good_lost`` and ``toxic_lost`` are the removed that are labelled so, ``shapley`` is what
    the filter removes summed over all orders.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS)).cast("int").alias("salt")
    rows = marked.select("part", salt, "mask", "good", "toxic")
    sums = rows.mapInArrow(_sums(filters), SUMS)
    sums = sums.repartition("part", "salt").sortWithinPartitions("part", "salt")
    sums = sums.mapInArrow(_merge, SUMS).withColumn("salt", F.lit(0))
    sums = sums.repartition("part").sortWithinPartitions("part")
    return sums.mapInArrow(_unpack(filters), AUDIT)
