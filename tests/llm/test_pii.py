"""Personal data against plain patterns, and the trees against plain boosting."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from shelfcast.llm import pii, queries

FOLDER = "/root/testdata/sf0.01"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TEXTS = [
    None,
    "",
    "a@b.c",
    "a@b.c_d@e.f-g@h.i.j@k",
    "x@y z@w. q@r..s %+-@-.-",
    "🙂🙂 me@example.org é 10.0.0.1 and 256.1.1.1, 1.2.3.4.5.6.7.8 00255.0.0.01 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111 1111 1111",
    "41111111111111114111 4111111111111111 378282246310005-",
    "+1 (555) 123-4567 +1 2 +123456789 ++44 20 7946 0958. +1234567890123456 +1()))",
    "0" * 5000 + " " + "9" * 5000,
    "a" * 50_000 + " " + "a." * 20_000 + "@x.y",
    "1-" * 20_000 + "1",
    "call (555) 123 4567 or write to jo (at) example [dot] com, user@localhost",
    "4111111111111111 4012888888881881",
    "é@a.b",
    "\x00 +4 (0) 7 \n 10.0.0.1\n10.0.0.1",
]


def _luhn(digits):
    turned = [*map(int, reversed(digits))]
    return sum(v if i % 2 == 0 else 2 * v - 9 * (v > 4) for i, v in enumerate(turned)) % 10 == 0


def _strict(text):
    text = text or ""

    def digits(match):
        return re.sub("[^0-9]", "", match.group())

    yield from (("email", *m.span()) for m in EMAIL.finditer(text))
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) < 4 and int(part) < 256 for part in m.group().split(".")):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        if 13 <= len(digits(m)) <= 19 and _luhn(digits(m)):
            yield "card", *m.span()
    for m in PHONE.finditer(text):
        if 9 <= len(digits(m)) <= 15:
            yield "phone", *m.span()


def _found(df):
    return {
        row.doc_id: [(s.kind, s.start, s.end) for s in row.spans if s.kind in pii.BASE_KINDS]
        for row in df.collect()
    }


def test_strict_spans_are_those_of_the_plain_patterns(spark):
    rows = [(i, text, "clash", 1) for i, text in enumerate([*TEXTS, TEXTS[5]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, _text int")
    found = _found(pii.find(docs.repartition(3)))
    assert found == {i: [*_strict(text)] for i, text, *_ in rows}


def test_strict_spans_of_random_texts(spark):
    random.seed(5)
    alphabet = "aZ09.@+- ()_%é255"
    texts = ["".join(random.choices(alphabet, k=random.randrange(80))) for _ in range(3000)]
    texts += ["".join(random.choices("0123456789 -", k=40)) for _ in range(1000)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    assert _found(pii.find(docs)) == {i: [*_strict(text)] for i, text in enumerate(texts)}


def test_more_spans_than_a_block_of_sums(spark):
    text = " é ".join(f"u{i}@h{i}.org" for i in range(3 * pii.BLOCK + 7))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert _found(pii.find(docs)) == {1: [*_strict(text)]}


def test_query_on_the_test_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    want = {row.doc_id: [*_strict(row.text)] for row in docs.collect()}
    for row in queries.op12_personal_data(spark, FOLDER).collect():
        spans = [one.split(":") for one in row.spans.split(",")] if row.spans else []
        base = [(k, int(a), int(b)) for k, a, b in spans if k in pii.BASE_KINDS]
        assert base == want[row.doc_id]
        counts = [sum(k == kind for k, *_ in base) for kind in pii.BASE_KINDS]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts
        assert [pii.KINDS.index(k) for k, *_ in spans] == sorted(
            pii.KINDS.index(k) for k, *_ in spans
        )


def test_the_plan_has_no_python(spark):
    plan = queries.op12_personal_data(spark, FOLDER)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|MapPartitions|SerializeFromObject", plan)


# --- learning -------------------------------------------------------------------------


def _corpus():
    """Cards and phones among decoys: numbers inside words, and numbers without a checksum."""
    random.seed(9)
    for i in range(900):
        digits = "".join(random.choices("0123456789", k=15))
        check = next(d for d in "0123456789" if _luhn(digits + d))
        wrong = str((int(check) + 3) % 10)
        text = (
            f"pay with {digits}{check} now",
            f"key x{digits}{wrong}f ends",
            f"order {digits}{wrong} came",
            f"call +1 555 {i:03d} 4567 and u{i}@mail.org",
            f"build@host{i} failed",
        )[i % 5]
        yield i, text


def test_decoys_are_left_alone_and_lookalikes_are_found(spark):
    rows = [*_corpus(), (5000, "both 4111111111111111 4012888888881881 together")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    added = {
        row.doc_id: [s for s in row.spans if s.kind in pii.GENERATORS]
        for row in pii.find(docs).collect()
    }
    # a run of two cards fails the strict pattern, each of them looks like a card
    assert {(s.kind, s.start, s.end) for s in added.pop(5000)} >= {("run", 5, 21), ("run", 22, 38)}
    assert not any(added.values())


def _score(model, features):
    odds = model.start
    for node in model.trees:
        while node.feature:
            node = node.children[features[node.feature] > node.cut]
        odds += node.value
    return 1 / (1 + math.exp(-odds))


def test_boosting_is_that_of_a_plain_version(spark):
    docs = spark.createDataFrame([*_corpus()], "doc_id long, text string")
    scanned = pii.scan(docs).cache()
    held = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(3)) == 0
    each = scanned.select(held.alias("held"), F.explode("proposed").alias("one"))
    rows = [(r.held, r.one.known, r.one.features.asDict()) for r in each.collect()]
    model = pii.learn(scanned, rounds=3)
    train = [(known, f) for is_held, known, f in rows if not is_held]
    start = math.log(sum(k for k, _ in train) / sum(not k for k, _ in train))
    assert model.start == pytest.approx(start)
    plain = pii.Model(start, [], {})
    for tree in model.trees:
        scores = [_score(plain, f) for _, f in train]
        root = _plain_tree([(k - p, p * (1 - p), f) for (k, f), p in zip(train, scores)], 0)
        for _, f in train:
            assert _leaf(tree, f) == pytest.approx(_leaf(root, f), abs=1e-4)
        plain.trees.append(tree)
    # held-back spans at or above a threshold are strict ones
    for number, least in model.thresholds.items():
        above = [
            known
            for is_held, known, f in rows
            if is_held and f["generator"] == number and _score(model, f) >= least
        ]
        assert above and sum(above) >= pii.MIN_PRECISION * len(above)
    score = model.score(F.col("one.features")).alias("score")
    for row in each.select("one.features", score).distinct().collect():
        assert row.score == pytest.approx(_score(model, row.features.asDict()))


def _leaf(node, features):
    while node.feature:
        node = node.children[features[node.feature] > node.cut]
    return node.value


def _plain_tree(rows, depth):
    def sums(some):
        return sum(g for g, _, _ in some), sum(h for _, h, _ in some)

    def worth(some):
        g, h = sums(some)
        return g * g / (h + pii.SMOOTHING)

    best = (pii.MIN_GAIN, None, None)
    for name in pii.FEATURES:
        for cut in sorted({f[name] for *_, f in rows})[:-1]:
            low = [row for row in rows if row[2][name] <= cut]
            high = [row for row in rows if row[2][name] > cut]
            if min(sums(low)[1], sums(high)[1]) < pii.MIN_CURVE:
                continue
            gain = worth(low) + worth(high) - worth(rows)
            if gain > best[0] + pii.MIN_GAIN:
                best = (gain, name, cut)
    if depth == pii.DEPTH or best[1] is None:
        g, h = sums(rows)
        return pii.Node(pii.RATE * g / (h + pii.SMOOTHING))
    _, name, cut = best
    sides = [[r for r in rows if (r[2][name] > cut) == side] for side in (False, True)]
    return pii.Node(0.0, name, cut, [_plain_tree(side, depth + 1) for side in sides])


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a@b.org"), (2, None)], "doc_id long, text string")
    assert pii.learn(pii.scan(docs)) is None
    assert _found(pii.find(docs)) == {1: [("email", 0, 7)], 2: []}
    assert pii.find(docs.where("false")).collect() == []


def test_redaction(spark):
    rows = [(None, "é me@a.org, +1 555 123 4567!"), (2, None), (2, "10.0.0.1"), (3, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(pii.redact(docs).collect(), key=str) == sorted(
        [
            Row(doc_id=None, text="é [EMAIL], [PHONE]!"),
            Row(doc_id=2, text=""),
            Row(doc_id=2, text="[IP]"),
            Row(doc_id=3, text="none"),
        ],
        key=str,
    )
