"""Near-duplicate documents: one-permutation MinHash with optimal densification.

1. One hash per five-word shingle, one pass: its top bits choose a bin, the least hash
   of a bin is kept, and an empty bin borrows from a bin that a hash of its number and
   of the attempt points to. Four bins make a band.
2. Documents with the same shingle set are one class, which its smallest id stands for.
3. Classes meet in banded buckets. A bucket of n classes proposes n - 1 edges, a star
   around one of them, never all pairs.
4. Edges are confirmed on the full shingle sets; confirmed links make components.
5. A star can miss a link between two of its leaves. So buckets that still hold several
   components are searched again, in blocks of bounded size: first by bands, for classes
   that may be linked to another component, then among these by their full sets. Only
   classes outside a bucket's largest component go to more than one block. Only classes and
   links leave a task, never candidate pairs.

With 50 bands of four bins, a pair of similarity 0.75 shares no band with a probability
of 6e-9 and fewer than two with 1e-7.

Defined results: a text without words, or null, has an empty set and is linked with
nothing. Fewer than five words are one shingle. Rows of one id are one node. Rows with a
null id are linked like others, but name no component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.graph import components
from shelfcast.llm.textscan import (
    LOWER,
    NOT_BLANK,
    Words,
    bounded_batches,
    mix,
    release_memory,
    shards,
    utf8,
    weights,
)
from shelfcast.session import stage

SHINGLE = 5
PERCENT = 75
BANDS = 50
ROWS = 4
#: Texts are cut into shingles by this many bytes at a time.
SHARD_BYTES = 1 << 20
BLOCK = 768
BLOCK_SHINGLES = 1_000_000
#: Ids up to this many are broadcast to pick texts; more are joined by shuffle.
BROADCAST_IDS = 500_000
#: A bucket with more than one of so many rows is looked up by broadcast.
HOT_SHARE = 1000

_BINS = BANDS * ROWS
_ATTEMPTS = 64
_U64 = np.uint64


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
    """Sorted distinct shingle hashes of all texts, and where each text's begin."""
    words = Words(LOWER[data], offsets, NOT_BLANK)
    hashes, multiplier = words.hashes(), weights(size, 23)
    texts = len(offsets) - 1
    short = (words.counts > 0) & (words.counts < size)
    counts = np.where(short, 1, np.maximum(words.counts - size + 1, 0))
    padded = np.concatenate([hashes, np.zeros(size, _U64)])
    row = np.repeat(np.arange(texts), counts)
    at = words.first[row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    sums = np.zeros(len(row), _U64)
    for step in range(size):
        term = padded[at + step] * multiplier[step]
        term[step >= words.counts[row]] = 0
        sums += term
    sums += np.minimum(words.counts[row], size).astype(_U64)
    values = mix(sums)
    ends = np.cumsum(counts)
    for low, high in zip(ends - counts, ends):
        values[low:high].sort()
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    found = np.bincount(row[fresh], minlength=texts)
    return values[fresh], np.concatenate([[0], np.cumsum(found)])


def sketch(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The least hash of each bin of each text; empty bins borrow."""
    texts = len(first) - 1
    row = np.repeat(np.arange(texts), np.diff(first))
    place = row * _BINS + (((values >> _U64(32)) * _U64(_BINS)) >> _U64(32)).astype(np.int64)
    least = np.ones(len(values), bool)
    least[1:] = place[1:] != place[:-1]
    bins, full = np.zeros(texts * _BINS, _U64), np.zeros(texts * _BINS, bool)
    bins[place[least]], full[place[least]] = values[least], True
    empty = np.flatnonzero(~full & np.repeat(np.diff(first) > 0, _BINS))
    for attempt in range(_ATTEMPTS):
        if not len(empty):
            break
        number = (empty % _BINS).astype(_U64) + _U64(attempt * _BINS + 1)
        source = empty - empty % _BINS + (mix(number) % _U64(_BINS)).astype(np.int64)
        lent = full[source]
        bins[empty[lent]] = bins[source[lent]]
        empty = empty[~lent]
    for text in np.unique(empty // _BINS):  # very few bins are full: the next one lends
        mine = np.flatnonzero(full[text * _BINS : (text + 1) * _BINS])
        asking = empty[empty // _BINS == text] % _BINS
        source = mine[np.searchsorted(mine, asking) % len(mine)]
        bins[text * _BINS + asking] = bins[text * _BINS + source]
    return bins.reshape(texts, _BINS)


def bands(bins: np.ndarray) -> np.ndarray:
    """One key per band, different between bands."""
    keys = (bins * weights(_BINS, 31)).reshape(len(bins), BANDS, ROWS).sum(axis=2, dtype=_U64)
    return mix(keys + np.arange(1, BANDS + 1, dtype=_U64) * _U64(0x9E3779B97F4A7C15))


def _signatures(batches):
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for low, high in shards(offsets, SHARD_BYTES):
            part = data[offsets[low] : offsets[high]]
            values, first = shingles(part, offsets[low : high + 1] - offsets[low])
            counts = np.diff(first)
            keys = bands(sketch(values, first))
            sums = []
            for seed in (41, 43):
                total = np.concatenate([[_U64(0)], np.cumsum(mix(values + _U64(seed)))])
                sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
            filled = counts > 0
            ends = np.concatenate([[0], np.cumsum(filled * BANDS)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(low, high - low),
                    pa.array(counts, pa.int64()),
                    pa.array(sums[0]),
                    pa.array(sums[1]),
                    pa.ListArray.from_arrays(ends, keys[filled].ravel().view(np.int64)),
                ],
                ["doc_id", "n_shingles", "set1", "set2", "bands"],
            )
    release_memory()


def _sets(batches):
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for low, high in shards(offsets, SHARD_BYTES):
            part = data[offsets[low] : offsets[high]]
            values, first = shingles(part, offsets[low : high + 1] - offsets[low])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(low, high - low),
                    pa.ListArray.from_arrays(first.astype(np.int32), values.view(np.int64)),
                ],
                ["doc_id", "shingles"],
            )
    release_memory()


def _sets_of(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc_id, shingles`` of the documents whose id is in ``nodes``."""
    nodes = stage(nodes, "nodes")
    if nodes.count() <= BROADCAST_IDS:
        nodes = F.broadcast(nodes)
    texts = docs.join(nodes, "doc_id", "left_semi")
    return stage(texts.mapInArrow(_sets, "doc_id long, shingles array<long>"), "shingles")


def _confirm(edges: DataFrame, docs: DataFrame) -> DataFrame:
    """The edges ``a, b`` whose full shingle sets are similar enough."""
    sets = _sets_of(edges.select("a").union(edges.select("b")).distinct().toDF("doc_id"), docs)
    pairs = edges.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    sizes = pairs.withColumn("common", F.size(F.array_intersect("set_a", "set_b")))
    union = F.size("set_a") + F.size("set_b") - F.col("common")
    return sizes.where(100 * F.col("common") >= PERCENT * union).select("a", "b")


def _outsiders(table: pa.Table):
    """Of a group: each visitor, and whom of the residents it must meet.

    Every pair of different components has a member outside the largest one, and all of these
    visit every block. Of two outsiders the one with the smaller id visits the other.
    """
    _, number = np.unique(table["component"].to_numpy(), return_inverse=True)
    reps, resident = table["rep"].to_numpy(), table["resident"].to_numpy(zero_copy_only=False)
    outside = table["outside"].to_numpy(zero_copy_only=False)
    for one in np.flatnonzero(~resident):
        later = ~outside | (reps > reps[one])
        yield one, resident & (number != number[one]) & later


def _open_members(table: pa.Table) -> pa.Table:
    """``bucket, rep`` of classes that may have a link to another component.

    Such a pair is like in size and shares a second band. It is looked at in the bucket of
    the first band that it shares.
    """
    table = table.combine_chunks()
    keys = table["bands"].chunk(0).flatten().to_numpy().reshape(-1, BANDS)
    size, bucket = table["n_shingles"].to_numpy(), table["bucket"][0].as_py()
    band = int(np.argmax(keys[0] == bucket))
    wanted = np.zeros(len(keys), bool)
    for one, other in _outsiders(table):
        low, high = np.minimum(size, size[one]), np.maximum(size, size[one])
        other = np.flatnonzero(other & (100 * low >= PERCENT * high))
        same = keys[other] == keys[one]
        other = other[(same.sum(axis=1) >= 2) & ~same[:, :band].any(axis=1)]
        wanted[other] = True
        wanted[one] |= len(other) > 0
    return table.select(["bucket", "rep"]).filter(pa.array(wanted))


def _links_between(table: pa.Table) -> pa.Table:
    """Links between components of a group, by the full shingle sets."""
    table = table.combine_chunks()
    sets, ids = table["shingles"].chunk(0), table["rep"].to_numpy()
    _, number = np.unique(sets.flatten().to_numpy(), return_inverse=True)
    size = sets.value_lengths().to_numpy().astype(np.int64)
    first = np.cumsum(size) - size
    inside, left, right = np.zeros(len(number), np.int32), [ids[:0]], [ids[:0]]
    for one, other in _outsiders(table):
        mine = number[first[one] : first[one] + size[one]]
        inside[mine] = 1
        common = np.add.reduceat(inside[number], first)
        inside[mine] = 0
        linked = other & (100 * common >= PERCENT * (size[one] + size - common))
        right.append(ids[linked])
        left.append(np.full(len(right[-1]), ids[one]))
    a, b = np.concatenate(left), np.concatenate(right)
    return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})


def _spread(members: DataFrame) -> DataFrame:
    """Buckets with several components: the largest one, and into how many blocks they go.

    ``blocks`` of about ``BLOCK`` classes or ``BLOCK_SHINGLES`` shingles, and ``visits`` of as
    many outsiders.
    """
    parts = members.groupBy("bucket", "component").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("size")
    )
    largest = F.max(F.struct("n", "component", "size"))
    spread = parts.groupBy("bucket").agg(
        F.count("*").alias("components"),
        largest.alias("largest"),
        F.sum("n").alias("n"),
        F.sum("size").alias("size"),
    )

    def parts_of(n, size):
        return F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_SHINGLES), F.lit(1).cast("long"))

    return spread.where("components > 1").select(
        "bucket",
        F.col("largest.component").alias("largest"),
        parts_of(F.col("n"), F.col("size")).alias("blocks"),
        parts_of(F.col("n") - F.col("largest.n"), F.col("size") - F.col("largest.size")).alias(
            "visits"
        ),
    )


def _blocks(members: DataFrame, columns: list[str]) -> DataFrame:
    """Members of every bucket with several components, dealt to groups of bounded size.

    Every member is resident in one block of its bucket. Those outside the largest component
    visit all blocks, some in each of ``visits`` groups that a block has. So a bucket with few
    outsiders makes few more rows than it has members, however large it is.
    """
    spread = stage(_spread(members), "spread")
    small = spread.count() <= BROADCAST_IDS
    dealt = members.join(F.broadcast(spread) if small else spread, "bucket")
    outside = F.col("component") != F.col("largest")
    home = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    turn = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("visits"))

    def every(count):
        return F.sequence(F.lit(0).cast("long"), F.col(count) - 1)

    def place(block, visit, resident):
        return F.struct(
            block.alias("block"), visit.alias("visit"), F.lit(resident).alias("resident")
        )

    places = F.transform(every("visits"), lambda visit: place(home, visit, True))
    calls = F.transform(every("blocks"), lambda block: place(block, turn, False))
    dealt = dealt.select(
        "bucket",
        "rep",
        "component",
        *columns,
        outside.alias("outside"),
        F.when(outside, F.concat(places, calls)).otherwise(places).alias("places"),
    )
    kept = ["bucket", "rep", "component", *columns, "outside"]
    return dealt.select(*kept, F.inline("places"))


def _members(reps: DataFrame) -> DataFrame:
    """``rep, bucket, center`` of classes that share a bucket with others.

    A bucket with over a thousandth of all rows, of which there are less than a thousand, gets
    its centre by broadcast, so none gathers in one task.
    """
    each = reps.select("rep", F.explode("bands").alias("bucket"))
    shared = each.groupBy("bucket").agg(
        F.min("rep").alias("center"), F.max("rep").alias("last"), F.count("*").alias("n")
    )
    shared = stage(shared.where("center <> last").select("bucket", "center", "n"), "buckets")
    hot = F.col("n") > reps.count() * BANDS / HOT_SHARE
    often, seldom = shared.where(hot), shared.where(~hot).select("bucket", "center")
    looked_up = each.join(F.broadcast(often), "bucket", "left")
    rest = looked_up.where("n is null").select("rep", "bucket").join(seldom, "bucket")
    found = looked_up.where("n is not null").select("rep", "bucket", "center")
    return found.unionByName(rest)


def _missed(members: DataFrame, reps: DataFrame, found: DataFrame, docs: DataFrame) -> DataFrame:
    """Links ``a, b`` between components that still share a bucket."""
    labels = found.withColumnRenamed("node", "rep")
    placed = members.join(labels, "rep", "left").join(reps.select("rep", "n_shingles"), "rep")
    placed = stage(
        placed.select(
            "bucket", "rep", F.coalesce("component", "rep").alias("component"), "n_shingles"
        ),
        "placed",
    )
    groups = _blocks(placed, ["n_shingles"]).join(reps.select("rep", "bands"), "rep")
    wanted = groups.groupBy("bucket", "block", "visit").applyInArrow(
        _open_members, "bucket long, rep long"
    )
    wanted = stage(placed.join(wanted.distinct(), ["bucket", "rep"]), "open")
    sets = _sets_of(wanted.select(F.col("rep").alias("doc_id")).distinct(), docs)
    groups = _blocks(wanted, []).join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    links = groups.groupBy("bucket", "block", "visit").applyInArrow(_links_between, "a long, b long")
    return links.distinct()


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``. Ids are whole numbers.

    ``component_id`` is the smallest id reachable over links, ``kept`` whether it is one's own.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = stage(
        docs.mapInArrow(
            _signatures,
            "doc_id long, n_shingles long, set1 long, set2 long, bands array<long>",
        ),
        "signatures",
    )
    key = ["set1", "set2", "n_shingles"]
    named = signed.where("n_shingles > 0 and doc_id is not null")
    classes = named.groupBy(*key).agg(F.min(F.struct("doc_id", "bands")).alias("first"))
    classes = stage(classes.select(*key, "first.*").withColumnRenamed("doc_id", "rep"), "classes")
    reps = classes.select("rep", "n_shingles", "bands")

    members = stage(_members(reps), "members")
    star = members.where("rep <> center").select("rep", "center").toDF("a", "b").distinct()
    links = stage(_confirm(stage(star, "edges"), docs), "confirmed")

    members = members.select("bucket", "rep")
    missed = stage(_missed(members, reps, components(links), docs), "missed")
    labels = components(links.union(missed)).withColumnRenamed("node", "rep")

    assigned = signed.select("doc_id", *key).join(classes.select(*key, "rep"), key, "left")
    assigned = assigned.join(labels, "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    return assigned.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id.

    Rows with a null id stay. Where ids repeat, every row is a node of its own, so rows of one
    id go only if their own text is linked; of rows with the same smallest id the one with the
    smallest hash of the text, then of all columns, is kept.
    """
    known = docs.where(F.col(doc_id).isNotNull())
    if known.groupBy(doc_id).count().where("count > 1").isEmpty():
        found = stage(find(docs, doc_id, text).where("doc_id is not null"), "components")
        dropped = found.where("not kept").select(found["doc_id"].alias(doc_id))
        return _without(docs, dropped, doc_id).select(docs.columns)

    order = [F.col(doc_id).cast("long").alias("id")]
    order += [F.xxhash64(F.col(text)).alias("text"), F.xxhash64(F.struct("*")).alias("all")]
    numbered = docs.select(
        F.struct("*").alias("row"),
        F.col(text).alias("text"),
        F.struct(*order).alias("order"),
        F.monotonically_increasing_id().alias("node"),
    )
    numbered = stage(numbered, "numbered")
    labels = find(numbered, "node", "text").select(F.col("doc_id").alias("node"), "component_id")
    nodes = numbered.where("order.id is not null").select("node", "order").join(labels, "node")
    nodes = stage(nodes, "components")
    first = nodes.groupBy("component_id").agg(F.min(F.struct("order", "node")).alias("first"))
    dropped = nodes.join(first.select("first.node"), "node", "left_anti").select("node")
    return _without(numbered, dropped, "node").select(
        *[F.col("row")[name].alias(name) for name in docs.columns]
    )


def _without(rows: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    dropped = stage(dropped, "dropped")
    small = dropped.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(dropped) if small else dropped, key, "left_anti")
