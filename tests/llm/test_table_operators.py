"""Operators on whole tables against brute force, the pipeline, and the SQL oracles."""

from __future__ import annotations

import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shelfcast.llm import graph, mixing, neardup, queries, urlfilter
from shelfcast.llm.oracle import ORACLES
from shelfcast.llm.urlfilter import Rule

FOLDER = "/root/testdata/sf0.001"

# --- URL filter ----------------------------------------------------------------------

URLS = [
    None,
    "",
    "no scheme.org/",
    "http://Example.ORG/es/x?q#f",
    "http://a.example.org/en/123",
    "http://example.org",
    "http://notexample.org/en/1",
    "https://x.com/fr/a://b/de/",
    "https://x.com/de/",
    "https://com/de/1",
    "ftp://x.net/" + "p" * 3000,
    "http://org/?/",
    "http://a..org/x",
    "://",
]
RULES = queries.URL_RULES


def _verdict(url, listed):
    match = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = match.groups() if match else ("", "")
    host = host.translate({u: u + 32 for u in range(65, 91)})
    fitting = [
        rule
        for rule in RULES
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)
    ]
    if fitting:
        rule = max(fitting, key=lambda r: (len(r.key), len(r.host)))
        return host, path, rule.key, "block" if rule.block else "allow"
    return host, path, None, "block" if host + path in listed else "allow"


@pytest.mark.parametrize(("local", "shard"), [(20_000, 4_000_000), (0, 2)])
def test_urls_are_judged_like_by_search(spark, monkeypatch, local, shard):
    monkeypatch.setattr(urlfilter, "LOCAL_KEYS", local)
    monkeypatch.setattr(urlfilter, "SHARD_KEYS", shard)
    urls = [*URLS, URLS[3], *(f"http://s{i}.net/{i % 7}" for i in range(60))]
    listed = {f"s{i}.net/{i % 7}" for i in range(0, 60, 9)} | {"never.seen/"}
    rows = [(i, url, "clash") for i, url in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    blocked = spark.createDataFrame([(key,) for key in [*listed, None]], "key string")
    found = urlfilter.judge(pages, RULES, blocked).orderBy("page_id").collect()
    assert len(found) == len(urls)
    for row, url in zip(found, urls):
        assert (row.host, row.path, row.rule, row.verdict) == _verdict(url, listed)


def test_urls_without_lists_or_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert urlfilter.judge(pages, []).first().verdict == "allow"
    assert urlfilter.judge(pages.where("false"), [Rule("org", "/", True)]).collect() == []


def test_mirrors(spark):
    rows = [
        (1, "http://a/x", "same"),
        (2, "http://b/y", "same"),
        (3, "http://a/x", "same"),
        (4, "http://c/z", None),
        (5, "http://c/w", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [row.key for row in urlfilter.mirrors(pages).collect()] == ["b/y"]


# --- components and near duplicates --------------------------------------------------


def test_components_of_long_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    hub = [(7, i) for i in range(200, 260)]
    links = [*chain, *hub, (300, 300), (None, 4), (101, 100), (101, 100)]
    found = dict(map(tuple, graph.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 260)]}


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({u: u + 32 for u in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def _near(rows):
    """``id: (set size, component)`` by comparing all pairs."""
    sets = [(name, _shingles(text)) for name, text in rows]
    root = {name: name for name, _ in sets}

    def find(name):
        while root[name] != name:
            name = root[name]
        return name

    for i, (a, left) in enumerate(sets):
        for b, right in sets[:i]:
            if left and 100 * len(left & right) >= 75 * len(left | right):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {name: (len(one), find(name)) for name, one in sets}


def _families(seed):
    """Hubs with copies that are near the hub but not each other, chains, exact copies."""
    draw, rows = random.Random(seed), []

    def words(n):
        return [f"w{draw.randrange(10**6)}" for _ in range(n)]

    for _ in range(4):
        base = words(draw.choice([40, 90, 200]))
        rows.append(base)
        for _ in range(40):
            copy = list(base)
            for _ in range(max(1, round(len(copy) * draw.choice([0.01, 0.02, 0.03, 0.06])))):
                copy[draw.randrange(len(copy))] = words(1)[0]
            rows.append(copy)
        rows += [list(base)] * 5
        for _ in range(8):  # a chain: each is near the one before only
            base = base[3:] + words(3)
            rows.append(base)
    rows += [words(30) for _ in range(20)]
    texts = [" ".join(row) for row in rows]
    texts += ["", None, " \n", "one two", "ONE  two", "one two three", "a b c d e", "A B C D E"]
    draw.shuffle(texts)
    return [*enumerate(texts, 1000)]


@pytest.mark.parametrize("block", [None, 7])
def test_near_duplicates(spark, monkeypatch, block):
    if block:
        monkeypatch.setattr(neardup, "BLOCK", block)
    rows = _families(block or 1)
    docs = spark.createDataFrame([(*row, 0) for row in rows], "doc_id long, text string, kept int")
    docs = docs.union(docs.where("doc_id = 1000")).union(
        docs.where("doc_id = 1001").withColumn("doc_id", F.lit(None).cast("long"))
    )
    found = neardup.find(docs).collect()
    assert len(found) == len(rows) + 2
    want = _near(rows)
    for row in found:
        if row.doc_id is not None:
            assert (row.n_shingles, row.component_id) == want[row.doc_id]
            assert row.kept == (row.doc_id == row.component_id)
    if block:
        return
    left = neardup.deduplicate(docs)
    assert left.columns == docs.columns
    ids = [row.doc_id for row in left.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({one for _, one in want.values()})
    assert ids.count(None) == 1


def test_rows_of_a_large_bucket_follow_its_members(spark):
    sizes = {}
    for n, outsiders in ((8_000, 1), (32_000, 1), (32_000, 40)):
        members = spark.range(n).select(
            F.lit(5).cast("long").alias("bucket"),
            F.col("id").alias("rep"),
            F.when(F.col("id") < outsiders, F.col("id")).otherwise(-1).alias("component"),
            F.lit(10).cast("long").alias("n_shingles"),
        )
        groups = neardup._blocks(members, ["n_shingles"]).cache()
        sizes[n, outsiders] = groups.count()
        largest = groups.groupBy("bucket", "block", "visit").count().agg(F.max("count")).first()[0]
        assert largest < 2 * neardup.BLOCK
        # every outsider meets every member once
        met = groups.where("resident").select("block", "visit").join(
            groups.where("not resident").select("block", "visit", "rep"), ["block", "visit"]
        )
        assert met.count() == n * outsiders
    assert sizes[32_000, 1] <= 4.5 * sizes[8_000, 1]
    assert sizes[32_000, 40] < 1.1 * sizes[32_000, 1]


def test_deduplication_where_ids_repeat(spark):
    x, y, z = (" ".join(f"{letter}{i}" for i in range(30)) for letter in "xyz")
    rows = [(1, x), (2, x), (2, y), (3, z), (3, f"{y} more"), (None, x), (4, None), (4, "")]
    docs = spark.createDataFrame([(*row, 7) for row in rows], "doc_id long, text string, node int")
    kept = [(row.doc_id, row.text) for row in neardup.deduplicate(docs).collect()]
    assert sorted(kept, key=str) == sorted(
        [(1, x), (2, y), (3, z), (None, x), (4, None), (4, "")], key=str
    )


def test_deduplication_of_random_rows_with_repeated_ids(spark):
    draw = random.Random(8)
    bodies = [" ".join(draw.choices("abcdefgh", k=40)) for _ in range(12)]
    rows = []
    for _ in range(120):
        body = draw.choice(bodies)
        rows.append((draw.randrange(40), body + draw.choice(["", " end", " quite other end"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(row) for row in neardup.deduplicate(docs.repartition(3)).collect()]
    # as nodes of their own
    groups = {}
    for place, (_, component) in _near([(i, text) for i, (_, text) in enumerate(rows)]).items():
        groups.setdefault(component, []).append(rows[place])
    assert len(kept) == len(groups)
    for group in groups.values():
        least = min(name for name, _ in group)
        mine = [row for row in kept if row in group]
        assert [name for name, _ in mine] == [least]
    again = [tuple(row) for row in neardup.deduplicate(docs.repartition(5)).collect()]
    assert sorted(again) == sorted(kept)


def test_near_duplicates_of_nothing(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    found = sorted(map(tuple, neardup.find(docs).collect()))
    assert found == [(1, 0, 1, True), (2, 0, 2, True)]
    assert neardup.find(docs.where("false")).collect() == []


# --- mixing --------------------------------------------------------------------------


def test_mixing_meets_its_targets(spark):
    draw = random.Random(2)
    rows = []
    for i in range(3000):
        source = draw.choice(["a", "a", "a", "b", "c", None])
        text = draw.choice(["x" * draw.randrange(1, 2000), "1 | 2", "figure 7", None, ""])
        rows.append((i, text, draw.choice(["en", "en", "de"]), source, 0.5))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _rate double")
    goal = {"source": {"a": 1.0, "b": 1.0, "c": 2.0, "": 0.0}, "lang": {"en": 0.5, "de": 0.5}}
    tables = {
        name: spark.createDataFrame([*map(tuple, shares.items())], "value string, share double")
        for name, shares in goal.items()
    }
    found = mixing.sampled(docs, targets=tables)
    sampled = found.collect()
    assert len(sampled) == len(rows)
    assert max(row._rate for row in sampled) == pytest.approx(1)
    tokens = {row.doc_id: row._tokens * row._rate for row in sampled}
    total = sum(tokens.values())
    for place, name in ((3, "source"), (2, "lang")):
        whole = sum(goal[name].values())
        for value, share in goal[name].items():
            got = sum(tokens[row[0]] for row in rows if (row[place] or "") == value)
            assert got / total == pytest.approx(share / whole, abs=1e-3)
    assert not any(row._sampled for row in sampled if row.source is None)
    assert all(row._sampled for row in sampled if row._rate > 0.999999)
    kept = sum(row._tokens for row in sampled if row._sampled)
    assert kept == pytest.approx(total, rel=0.1)
    assert mixing.mix(docs, targets=tables).columns == docs.columns


def test_rates_are_those_of_plain_fitting(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = mixing.sampled(docs).withColumn("topic", mixing.topic_of()).collect()
    names = {d: sorted({row[d] for row in rows}) for d in mixing.DIMENSIONS}
    cells = np.zeros([len(names[d]) for d in mixing.DIMENSIONS])
    places = [tuple(names[d].index(row[d]) for d in mixing.DIMENSIONS) for row in rows]
    for row, place in zip(rows, places):
        cells[place] += row._tokens
    goal = []
    for axis, name in enumerate(mixing.DIMENSIONS):
        sums = cells.sum(axis=tuple(a for a in range(3) if a != axis)) ** mixing.POWERS[name]
        goal.append(sums / sums.sum())
    fitted = cells.copy()
    for _ in range(200):
        for axis in range(3):
            sums = fitted.sum(axis=tuple(a for a in range(3) if a != axis))
            fitted *= np.expand_dims(goal[axis] / sums, [a for a in range(3) if a != axis])
    rates = np.divide(fitted, cells, out=np.zeros_like(cells), where=cells > 0)
    rates /= rates.max()
    assert np.allclose([row._rate for row in rows], [rates[place] for place in places], rtol=1e-3)


def _held_rates(rows, share):
    """Rates by solving for each factor by bisection, in turn."""
    names = {d: sorted({row[d] for row in rows}) for d in mixing.DIMENSIONS}
    places = [tuple(names[d].index(row[d]) for d in mixing.DIMENSIONS) for row in rows]
    cells = np.zeros([len(names[d]) for d in mixing.DIMENSIONS])
    for row, place in zip(rows, places):
        cells[place] += row._tokens
    budget, goals, factors = share * cells.sum(), [], []
    for axis, name in enumerate(mixing.DIMENSIONS):
        sums = cells.sum(axis=tuple(a for a in range(3) if a != axis))
        low, high = 0.0, 1e9
        for _ in range(200):
            each = (low + high) / 2
            goal = np.minimum(sums, each * sums ** mixing.POWERS[name])
            low, high = (each, high) if goal.sum() < budget else (low, each)
        goals.append(goal)
        factors.append(np.ones(len(sums)))
    for _ in range(100):
        for axis in range(3):
            others = [f if a != axis else np.ones(len(f)) for a, f in enumerate(factors)]
            fitted = np.moveaxis(np.einsum("i,j,k->ijk", *others), axis, 0)
            own = np.moveaxis(cells, axis, 0)
            for v, goal in enumerate(goals[axis]):
                low, high = 0.0, 1e6
                for _ in range(80):
                    each = (low + high) / 2
                    got = (own[v] * np.minimum(1, each * fitted[v])).sum()
                    low, high = (each, high) if got < goal * (1 - 1e-12) else (low, each)
                factors[axis][v] = high
    rates = np.minimum(1, np.einsum("i,j,k->ijk", *factors))
    return [rates[place] for place in places], budget


def test_rare_cells_do_not_shrink_the_sample(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = docs.select("doc_id", "text", "lang", "source")
    rare = [(-1, "x", "xx", "rare"), (-2, "y" * 800, "en", "new"), (-3, "z", None, None)]
    docs = docs.union(spark.createDataFrame(rare, docs.schema))
    found = mixing.sampled(docs, share=0.75).withColumn("topic", mixing.topic_of())
    rows = found.fillna("", ["lang", "source"]).collect()
    assert len(rows) == docs.count()
    want, budget = _held_rates(rows, 0.75)
    assert np.allclose([row._rate for row in rows], want, rtol=2e-2)
    expected = sum(row._tokens * row._rate for row in rows)
    assert expected == pytest.approx(budget, rel=1e-3)
    assert max(row._rate for row in rows) <= 1
    assert all(row._sampled for row in rows if row.doc_id in (-1, -2, -3))
    kept = sum(row._tokens for row in rows if row._sampled)
    assert kept == pytest.approx(budget, rel=0.15)


def test_mixing_sizes(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id is not null")
    none = spark.createDataFrame([("en", 0.0), ("de", 1.0)], "value string, share double")
    assert all(row._sampled for row in mixing.sampled(docs, share=1.0).collect())
    rows = mixing.sampled(docs, targets={"lang": none}, budget=1e12).collect()
    assert all(row._sampled == (row.lang != "en") for row in rows)
    assert mixing.mix(docs, budget=0).collect() == []


def test_mixing_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    assert mixing.mix(docs).collect() == []


def test_misses_of_a_mix(spark):
    rows = [(i, "x" * 400, "en", "ab"[i % 2]) for i in range(100)]
    rows += [(i, "x" * 400, "de", "a") for i in range(100, 104)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    even = {"source": spark.createDataFrame([("a", 1.0), ("b", 1.0)], "value string, share double")}
    met = {(r.dimension, r.value): r for r in mixing.misses(docs, targets=even).collect()}
    assert met["source", "a"].asked == 0.5
    assert all(abs(r.asked - r.expected) < 1e-3 for r in met.values())
    # more German than there is, for a sample of three quarters
    asked = {"lang": spark.createDataFrame([("de", 1.0), ("en", 1.0)], "value string, share double")}
    off = {(r.dimension, r.value): r for r in mixing.misses(docs, targets=asked, share=0.75).collect()}
    assert off["lang", "de"].asked == 0.5
    assert off["lang", "de"].expected == pytest.approx(4 / 78, abs=0.01)
    assert mixing.misses(docs.where("false")).collect() == []


# --- queries and pipeline ------------------------------------------------------------


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_its_oracle(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "conversations", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = queries.QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(map(str, result.fetchall()))
    assert sorted(str(tuple(row)) for row in df.select(names).collect()) == want


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "near duplicates",
        "decontamination",
        "mixing",
        "token planes",
    ]
    judged = {r.doc_id for r in queries.op5_quality_rules(spark, FOLDER).where("kept").collect()}
    ruled = corpus_pipeline.quality_rules(spark, docs, FOLDER)
    assert {row.doc_id for row in ruled.collect()} == judged

    single = corpus_pipeline.near_duplicates(spark, ruled, FOLDER)
    near = _near([(row.doc_id, row.text) for row in ruled.collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted({one for _, one in near.values()})

    clean = corpus_pipeline.decontaminated(spark, single, FOLDER)
    before = {row.doc_id: row.text for row in single.collect()}
    after = {row.doc_id: row for row in clean.collect()}
    hit = queries.op1_decontaminate(spark, FOLDER).where("contaminated").collect()
    hit = {row.doc_id for row in hit} & before.keys()
    assert all(after[i].text == text for i, text in before.items() if i not in hit)
    assert all(after[i].n_chars == len(after[i].text) for i in hit & after.keys())

    mixed = corpus_pipeline.mixed(spark, clean, FOLDER)
    assert {row.doc_id for row in mixed.collect()} <= after.keys()
    for stage in (ruled, single, clean, mixed):
        assert stage.columns == docs.columns

    last = corpus_pipeline.run(spark, FOLDER).orderBy("doc_id").collect()
    assert [row.doc_id for row in last] == sorted(row.doc_id for row in mixed.collect())
    assert [row.start for row in last[1:]] == [row.start + row.n_tokens for row in last[:-1]]
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    texts = {row.doc_id: row.text for row in mixed.collect()}
    for row in last:
        ids = [*library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids, 1]
        assert row.n_tokens == len(ids)
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
