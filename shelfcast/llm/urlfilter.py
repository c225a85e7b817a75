"""URL filters by a cascade of Bloom filters, exact over the corpus's keys.

A key is a host, or a host and the beginning of a path. The first level of a cascade holds
the listed keys, the second those keys of the corpus that the first one takes for listed,
the third the listed keys that the second one takes for those, and so on until no key is
mistaken. As every key that will be asked for is in the universe the cascade was built
over, each answer is exact, and asking takes a few bit tests instead of a join.

Levels are built where the keys are: each task sets bits, Spark ORs the words. Only filters
reach the driver and the tasks. A list of more than ``SHARD_KEYS`` keys is dealt out by key
to several cascades, each probed in its own pass, so no broadcast grows with the list. When
no more than ``LOCAL_KEYS`` keys are left in question, the last levels are built from them
on the driver.

Defined results: a null URL, or one without ``://``, has an empty host and path and is
judged like any other. Null keys are not listed. Of two fitting rules of one length the one
with the longer host wins. Rows may repeat; an empty list blocks nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfcast.llm.textscan import mix
from shelfcast.session import stage

SHARD_KEYS = 4_000_000
LOCAL_KEYS = 20_000
MAX_LEVELS = 200

_U64 = np.uint64
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and the beginning of a path."""

    host: str
    path: str
    block: bool

    @property
    def key(self) -> str:
        return self.host + self.path


# --- filters ------------------------------------------------------------------------


@dataclass
class Level:
    number: int
    size: int
    probes: int
    words: np.ndarray

    def places(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        salt = _U64(self.number) * _U64(0x9E3779B97F4A7C15)
        start, step = mix(first + salt), mix(second ^ salt) | _U64(1)
        turns = np.arange(self.probes, dtype=_U64)[:, None]
        return ((start + turns * step) % _U64(self.size)).astype(np.int64)

    def holds(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        found = np.ones(len(first), bool)
        for place in self.places(first, second):
            found &= (self.words[place >> 6] >> (place & 63).astype(_U64)) & _U64(1) != 0
        return found

    def bits(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words with bits, and their bits."""
        place = np.unique(self.places(first, second))
        word, at = np.unique(place >> 6, return_index=True)
        if not len(word):
            return word, np.zeros(0, _U64)
        return word, np.bitwise_or.reduceat(_U64(1) << (place & 63).astype(_U64), at)


def _level(number: int, keys: int, share: float) -> Level:
    """An empty level for so many keys, that takes about ``share`` of others for them."""
    share = min(0.5, max(share, 1e-9))
    size = 64 * math.ceil(max(keys, 1) * -math.log2(share) / math.log(2) / 64)
    return Level(number, size, max(1, round(-math.log2(share))), np.zeros(size // 64, _U64))


@dataclass
class Cascade:
    shard: int = 0
    shards: int = 1
    levels: list[Level] = field(default_factory=list)

    def holds(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Which keys are listed; keys of other shards are not looked at."""
        mine = np.flatnonzero(first % _U64(self.shards) == _U64(self.shard))
        found, asked = np.zeros(len(first), bool), mine
        for level in self.levels:
            passed = level.holds(first[asked], second[asked])
            # leaving at an even level: not among what the level before mistook
            found[asked[~passed]] = level.number % 2 == 1
            asked = asked[passed]
        found[asked] = len(self.levels) % 2 == 1
        return found


def _pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))


def _fill(level: Level, keys: DataFrame) -> None:
    """Set the bits of all keys: partial words per task, then OR."""
    empty = Level(level.number, level.size, level.probes, np.zeros(0, _U64))

    def partial(batches):
        for batch in batches:
            word, bits = empty.bits(*_pairs(batch))
            yield pa.RecordBatch.from_arrays(
                [pa.array(word), pa.array(bits.view(np.int64))], ["word", "bits"]
            )

    words = keys.select("first", "second").mapInArrow(partial, "word long, bits long")
    merged = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    level.words[merged["word"].to_numpy()] = merged["bits"].to_numpy().view(np.uint64)


def _held(level: Level, keys: DataFrame) -> DataFrame:
    broadcast = keys.sparkSession.sparkContext.broadcast(level)

    def probe(batches):
        for batch in batches:
            yield batch.filter(pa.array(broadcast.value.holds(*_pairs(batch))))

    return keys.mapInArrow(probe, "first long, second long")


def _local(cascade: Cascade, inside, outside) -> None:
    """The remaining levels for two sets of hash pairs, as arrays."""
    while len(inside[0]):
        level = _level(len(cascade.levels), len(inside[0]), 0.5)
        if level.number > MAX_LEVELS:
            raise ValueError("two different keys have the same hashes")
        word, bits = level.bits(*inside)
        level.words[word] = bits
        cascade.levels.append(level)
        passed = level.holds(*outside)
        inside, outside = (outside[0][passed], outside[1][passed]), inside


def build(universe: DataFrame) -> list[Cascade]:
    """Cascades for ``universe``: rows ``key`` and ``listed``, each key once."""
    keys = universe.where("key is not null").select(
        F.xxhash64("key").alias("first"),
        F.xxhash64(F.lit(1), "key").alias("second"),
        "listed",
    )
    keys = stage(keys, "keys")
    total = keys.agg(F.count_if("listed").alias("n")).first().n
    shards, found = max(1, math.ceil(total / SHARD_KEYS)), []
    for shard in range(shards):
        # the same remainder as of the unsigned number that the filters see
        unsigned = F.when(F.col("first") < 0, F.lit(2**64 % shards)).otherwise(0)
        rest = F.pmod(F.pmod("first", F.lit(shards)) + unsigned, F.lit(shards))
        mine = keys.where(rest == shard) if shards > 1 else keys
        inside = mine.where("listed").select("first", "second")
        outside = mine.where("not listed").select("first", "second")
        n_in, n_out = inside.count(), outside.count()
        cascade = Cascade(shard, shards)
        while n_in:
            number = len(cascade.levels)
            if number and n_in + n_out <= LOCAL_KEYS:
                arrays = []
                for side in (inside.toArrow(), outside.toArrow()):
                    arrays.append([side[c].to_numpy().view(_U64) for c in ("first", "second")])
                _local(cascade, *arrays)
                break
            if number > MAX_LEVELS:
                raise ValueError("two different keys have the same hashes")
            share = 0.5 if number else math.sqrt(0.5) * n_in / max(n_out, 1)
            level = _level(number, n_in, share)
            _fill(level, inside)
            cascade.levels.append(level)
            mistaken = stage(_held(level, outside), "mistaken")
            inside, outside = mistaken, inside
            n_in, n_out = mistaken.count(), n_in
        found.append(cascade)
    return found


def ask(rows: DataFrame, key: str, answer: str, cascades: Iterable[Cascade]) -> DataFrame:
    """``rows`` with ``answer``: which keys of the array ``key`` are listed."""
    first, second = f"{answer}_first", f"{answer}_second"
    names = rows.columns
    out = rows.select(
        "*",
        F.transform(key, lambda one: F.xxhash64(one)).alias(first),
        F.transform(key, lambda one: F.xxhash64(F.lit(1), one)).alias(second),
        F.transform(key, lambda one: F.lit(False)).alias(answer),
    )
    schema = StructType([*out.schema.fields])
    for cascade in cascades:
        broadcast = rows.sparkSession.sparkContext.broadcast(cascade)

        def probe(batches, broadcast=broadcast):
            for batch in batches:
                one, two, flags = (batch.column(c) for c in (first, second, answer))
                pairs = [c.flatten().to_numpy().view(np.uint64) for c in (one, two)]
                held = broadcast.value.holds(*pairs)
                held |= flags.flatten().to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(one.value_lengths().to_numpy())])
                told = pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(held))
                place = batch.schema.get_field_index(answer)
                yield batch.set_column(place, answer, told)

        out = out.mapInArrow(probe, schema)
    return out.select(*names, answer)


# --- URLs ---------------------------------------------------------------------------


def host_of(url: str) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, _CAPITALS, _CAPITALS.lower())


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _candidates(rules: list[Rule]) -> Column:
    """All keys of a URL that have the shape of a rule, the longest first."""
    shapes = sorted({(rule.host.count(".") + 1, len(rule.path)) for rule in rules})
    dots = F.char_length("host") - F.char_length(F.replace("host", F.lit(".")))
    keys = []
    for labels, length in shapes:
        host = F.substring_index("host", ".", -labels)
        key = F.concat(host, F.substring("path", 1, length))
        fits = (dots >= labels - 1) & (F.char_length("path") >= length)
        shape = F.struct(F.char_length(key), F.char_length(host), key.alias("key"))
        keys.append(F.when(fits, shape))
    if not keys:
        return F.array().cast("array<string>")
    ordered = F.sort_array(F.array_compact(F.array(*keys)), asc=False)
    return F.transform(ordered, lambda one: one["key"])


def judge(pages: DataFrame, rules: list[Rule], blocked: DataFrame | None = None, url: str = "url"):
    """``pages`` with ``host``, ``path``, ``rule`` (its key, or null) and ``verdict``.

    A rule decides if one fits. Otherwise a URL is blocked if its host and path, put
    together, are a ``key`` of ``blocked``.
    """
    spark = pages.sparkSession
    out = pages.select(
        F.struct("*").alias("_page"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    out = out.withColumns({"_keys": _candidates(rules), "_own": F.array(F.concat("host", "path"))})

    listed = spark.createDataFrame([(r.key, r.block) for r in rules], "key string, block boolean")
    seen = out.select(F.explode("_keys").alias("key"), F.lit(False).alias("listed"))
    universe = seen.union(listed.select("key", F.lit(True))).groupBy("key")
    out = ask(out, "_keys", "_ruled", build(universe.agg(F.max("listed").alias("listed"))))
    # the rule that decides is among the listed keys, which are all that is asked for now
    ruled = F.filter(F.arrays_zip("_keys", "_ruled"), lambda one: one["_ruled"])
    out = out.withColumn("_rule", F.slice(F.transform(ruled, lambda one: one["_keys"]), 1, 1))
    out = ask(out, "_rule", "_stops", build(listed.withColumnRenamed("block", "listed")))

    if blocked is None:
        blocked = spark.createDataFrame([], "key string")
    seen = out.select(F.explode("_own").alias("key"), F.lit(False).alias("listed"))
    universe = seen.union(blocked.select("key", F.lit(True))).groupBy("key")
    out = ask(out, "_own", "_blocked", build(universe.agg(F.max("listed").alias("listed"))))

    told = ("host", "path", "rule", "verdict")
    stops = F.coalesce(F.get("_stops", F.lit(0)), F.get("_blocked", F.lit(0)))
    return out.select(
        *[F.col("_page")[name].alias(name) for name in pages.columns if name not in told],
        "host",
        "path",
        F.get("_rule", F.lit(0)).alias("rule"),
        F.when(stops, "block").otherwise("allow").alias("verdict"),
    )


def mirrors(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html"):
    """``key`` of every host and path whose pages all repeat the body of an earlier page."""
    rows = pages.select(
        F.col(page_id).alias("id"),
        F.concat(host_of(url), path_of(url)).alias("key"),
        F.sha2(body, 256).alias("body"),
    )
    origin = rows.groupBy("body").agg(F.min("id").alias("origin"))
    placed = rows.join(origin, "body", "left")
    copied = F.coalesce(F.col("id") > F.col("origin"), F.lit(False))
    keys = placed.groupBy("key").agg(F.bool_and(copied).alias("copied"))
    return keys.where("copied").select("key")
