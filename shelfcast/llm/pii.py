r"""Personal data in texts: candidate spans, boosted trees over them, calibrated thresholds.

1. Four strict patterns give spans that always stay: ``email``, ``ip``, ``card`` (13 to 19
   digits that pass Luhn's check) and ``phone``. Three generous ones propose spans besides, which
   overlap those and each other: ``mail`` (hosts without a dot, "(at)", "[dot]"), ``number``
   (seven digits and more with blanks, dots, hyphens, brackets) and ``run`` (the same without
   anything between, so also one of several card numbers in a row).
2. Format and context of a proposed span are small whole numbers (``FEATURES``). What is learnt
   is whether a span of such a format in such a context is one that a strict pattern keeps.
   Those that look alike but are not kept (a part of a longer one, say) are redacted too.
3. Gradient boosting with log loss: rows are summed to cells of equal features first, of which
   there are at most the product of ``FEATURES``, whatever the corpus. Every level of a tree
   takes one sum of gradients per node, feature and value; the driver sees those alone.
4. A third of the documents, by hash of the id, is held back. The threshold of a generator is
   the least score from which on ``MIN_PRECISION`` of the held-back spans are strict ones.
   Proposed spans at or above it are redacted as well.

The trees are CASE expressions. All of it is built of DataFrame functions; spans are found
and judged within the row of their text, and nothing but counts is shuffled.

Patterns start at the beginning of a run of their characters only, and repeat possessively: they
match what the plain ones do, in time linear in the text, without recursion.

Defined results: a null text is empty. Places are code points, the end exclusive. Rows may
repeat and ids may be null; each row has its own spans. Without proposed spans of
both sorts nothing is learnt, and only strict spans are found.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import stage

BASE_KINDS = ("email", "ip", "card", "phone")
GENERATORS = ("mail", "number", "run")
KINDS = (*BASE_KINDS, *GENERATORS)

_LOCAL = "A-Za-z0-9._%+-"
_LABEL = "[A-Za-z0-9-]++"
_AT = r"(?:@| ?[(\[{] ?(?i:at) ?[)\]}] ?)"
_DOT = r"(?:\.| ?[(\[{] ?(?i:dot) ?[)\]}] ?)"
# where a run of local characters begins, or the last match ended inside one
_RUN = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++"
PATTERNS = {
    "email": rf"{_RUN}@{_LABEL}(?:\.{_LABEL})++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?=(?:[0-9][ -]?){12}[0-9])[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "mail": rf"{_RUN}{_AT}{_LABEL}(?:{_DOT}{_LABEL})*+",
    "number": (
        r"(?<![0-9])(?=\+?\(?[0-9](?:[ ().-]{0,2}[0-9]){6})\+?\(?[0-9]++(?:[ ().-]{1,2}[0-9]++)*+"
    ),
    "run": r"(?<![0-9])[0-9]{7,}+",
}
# what a text must hold to be searched for the pattern
_HINTS = {"email": "@", "mail": rf"@|{_AT}"}
_DIGIT = "[0-9]"
_CUES = (
    r"(?i)\b(?:tel|phone|fax|call|mobile|card|visa|account|e-?mail|mail|contact|ip|host|addr"
    r"|telefon|konto|karte|carte|appel|tarjeta|correo|llame)"
)

#: Values per feature, 0 to this less one.
FEATURES = {
    "generator": 3,
    "digits": 8,
    "groups": 6,
    "dots": 5,
    "brackets": 2,
    "plus": 2,
    "blanks": 2,
    "distinct": 4,
    "luhn": 2,
    "before": 5,
    "after": 5,
    "cue": 2,
}
CONTEXT = 24
ROUNDS = 10
DEPTH = 3
RATE = 0.4
SMOOTHING = 1.0
MIN_GAIN = 1e-6
#: The least second derivative on either side of a split, so that no few rows decide on it.
MIN_CURVE = 1.0
MIN_PRECISION = 0.95
#: No threshold is below this, however few such spans are among better ones.
MIN_SCORE = 0.5
BLOCK = 512


# --- spans within a text ----------------------------------------------------------------


def _sums_before(lengths: str) -> Column:
    """For each element of an array column, the sum of those before it.

    Blocks of ``BLOCK`` are summed up by themselves first, so that appending to an array costs
    no square of the number of elements.
    """
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")

    def step(held, length):
        return F.struct(
            (held["total"] + length).alias("total"),
            F.concat(held["sums"], F.array(held["total"])).alias("sums"),
        )

    start = F.struct(zero.alias("total"), none.alias("sums"))
    count = F.ceil(F.size(lengths) / BLOCK).cast("int")
    blocks = F.transform(
        F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")),
        lambda block: F.aggregate(F.slice(lengths, block * BLOCK + 1, BLOCK), start, step),
    )

    def shifted(held, block):
        moved = F.transform(block["sums"], lambda one: one + held["total"])
        return F.struct(
            (held["total"] + block["total"]).alias("total"),
            F.concat(held["sums"], F.array(moved)).alias("sums"),
        )

    begin = F.struct(zero.alias("total"), F.array().cast("array<array<bigint>>").alias("sums"))
    return F.flatten(F.aggregate(blocks, begin, shifted)["sums"])


def _with_spans(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` with an array ``kind`` of ``start, end, match, before, after``.

    Splitting a text by a pattern gives what is between the matches, which gives their places.
    """
    pattern = PATTERNS[kind]
    worth = F.col("_text").rlike(_HINTS.get(kind, _DIGIT))
    none = F.array().cast("array<string>")
    rows = rows.withColumns(
        {
            "_found": F.when(worth, F.regexp_extract_all("_text", F.lit(pattern), 0)).otherwise(none),
            "_between": F.when(worth, F.split("_text", pattern, -1)).otherwise(none),
        }
    )
    count, edge = F.size("_found"), F.array(F.lit(""))
    rows = rows.withColumn(
        "_pieces",
        F.arrays_zip(
            F.col("_found").alias("match"),
            F.slice("_between", 1, count).alias("before"),
            F.slice("_between", 2, count).alias("after"),
            F.slice(F.concat(edge, "_found"), 1, count).alias("last"),
            F.slice(F.concat("_found", edge), 2, count).alias("next"),
        ),
    )
    size = F.transform(
        "_pieces",
        lambda one: (F.char_length(one["before"]) + F.char_length(one["match"])).cast("long"),
    )
    rows = rows.withColumn("_sizes", size)
    rows = rows.withColumn("_sums", _sums_before("_sizes"))

    def span(one, before):
        start = before + F.char_length(one["before"])
        return F.struct(
            start.alias("start"),
            (start + F.char_length(one["match"])).alias("end"),
            one["match"].alias("match"),
            # what stands around may be part of other matches
            F.right(F.concat(one["last"], one["before"]), F.lit(CONTEXT)).alias("before"),
            F.left(F.concat(one["after"], one["next"]), F.lit(2)).alias("after"),
        )

    rows = rows.withColumn(kind, F.zip_with("_pieces", "_sums", span))
    return rows.drop("_found", "_between", "_pieces", "_sizes", "_sums")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _passes_luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def worth(place):
        value = F.substring(turned, place, F.lit(1)).cast("int")
        twice = value * 2 - F.when(value > 4, 9).otherwise(0)
        return F.when(place % 2 == 0, twice).otherwise(value)

    places = F.sequence(F.lit(1), F.char_length(digits))
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, b: a + b) % 10 == 0


def _is_ip(match: Column) -> Column:
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _has_checksum(digits: Column) -> Column:
    return F.when(F.char_length(digits).between(13, 19), _passes_luhn(digits)).otherwise(False)


def _is_card(match: Column) -> Column:
    return match.rlike(r"^[0-9]++(?:[ -][0-9]++)*+$") & _has_checksum(_digits(match))


def _is_phone(match: Column) -> Column:
    fits = match.rlike(r"^\+[0-9][ ().0-9-]+[0-9]$")
    return fits & F.char_length(_digits(match)).between(9, 15)


_CHECKS = {"ip": _is_ip, "card": _is_card, "phone": _is_phone}


def _surrounding(char: Column) -> Column:
    """0 edge of the text or blank, 1 letter, 2 digit, 3 quote or assignment, 4 any other."""
    return (
        F.when((char == "") | char.rlike(r"^\s"), 0)
        .when(char.rlike(r"^\p{L}"), 1)
        .when(char.rlike("^[0-9]"), 2)
        .when(char.rlike("""^["'`=:/_]"""), 3)
        .otherwise(4)
    )


def _features(number: int, one: Column) -> Column:
    match, digits = one["match"], _digits(one["match"])
    dots = F.regexp_count(match, F.lit(_DOT if number == 0 else r"\."))
    values = {
        "generator": F.lit(number),
        "digits": F.when(F.char_length(digits) < 7, 0)
        .when(F.char_length(digits) < 9, 1)
        .when(F.char_length(digits) < 11, 2)
        .when(F.char_length(digits) < 13, 3)
        .when(F.char_length(digits) < 16, 4)
        .when(F.char_length(digits) == 16, 5)
        .when(F.char_length(digits) < 20, 6)
        .otherwise(7),
        "groups": F.least(F.regexp_count(match, F.lit("[0-9]++")), F.lit(5)),
        "dots": F.least(dots, F.lit(4)),
        "brackets": F.contains(match, F.lit("(")).cast("int") if number else F.lit(0),
        "plus": match.startswith("+").cast("int"),
        "blanks": match.rlike("[ -]").cast("int") if number else F.lit(0),
        "distinct": F.floor(F.size(F.array_distinct(F.split(digits, ""))) / 3),
        "luhn": _has_checksum(digits).cast("int"),
        "before": _surrounding(F.right(one["before"], F.lit(1))),
        "after": _surrounding(F.left(one["after"], F.lit(1))),
        "cue": one["before"].rlike(_CUES).cast("int"),
    }
    held = [
        F.least(values[name].cast("int"), F.lit(size - 1)).alias(name)
        for name, size in FEATURES.items()
    ]
    return F.struct(*held)


def _known(kind: str, one: Column) -> Column:
    match = one["match"]
    if kind == "mail":
        return match.rlike(rf"^[{_LOCAL}]++@{_LABEL}(?:\.{_LABEL})++$")
    if kind == "run":
        goes_on = one["before"].rlike("[0-9][ -]$") | one["after"].rlike("^[ -][0-9]")
        return _is_card(match) & ~goes_on
    return reduce(Column.__or__, [check(match) for check in _CHECKS.values()])


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``strict`` (arrays of ``start, end`` by kind), ``proposed`` and ``_text``.

    A proposed span has its generator's number, whether it is ``known`` (a strict pattern keeps
    it as it is), and its ``features``.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")
    )
    for kind in KINDS:
        rows = _with_spans(rows, kind)

    def strict(kind):
        spans = F.col(kind)
        if kind in _CHECKS:
            spans = F.filter(spans, lambda one: _CHECKS[kind](one["match"]))
        return F.transform(spans, lambda one: F.struct(one["start"], one["end"])).alias(kind)

    def proposed(number, kind):
        return F.transform(
            kind,
            lambda one: F.struct(
                F.lit(number).alias("generator"),
                one["start"].alias("start"),
                one["end"].alias("end"),
                _known(kind, one).alias("known"),
                _features(number, one).alias("features"),
            ),
        )

    return rows.select(
        "doc_id",
        F.struct(*map(strict, BASE_KINDS)).alias("strict"),
        F.concat(*[proposed(*one) for one in enumerate(GENERATORS)]).alias("proposed"),
        "_text",
    )


# --- boosted trees ----------------------------------------------------------------------


@dataclass
class Node:
    """Features up to ``cut`` go to ``low``; without a feature it is a leaf."""

    value: float = 0.0
    feature: str | None = None
    cut: int = 0
    children: list[Node] = field(default_factory=list)

    def expression(self, features: Column) -> Column:
        if self.feature is None:
            return F.lit(self.value)
        low, high = (child.expression(features) for child in self.children)
        return F.when(features[self.feature] <= self.cut, low).otherwise(high)

    def place(self, features: Column, names: dict[int, Node], number: int = 1) -> Column:
        """The number of the leaf that a row comes to; ``names`` gets the leaves."""
        if self.feature is None:
            names[number] = self
            return F.lit(number)
        low, high = (
            child.place(features, names, 2 * number + side)
            for side, child in enumerate(self.children)
        )
        return F.when(features[self.feature] <= self.cut, low).otherwise(high)


@dataclass
class Model:
    """Log odds are ``start`` and the trees' values; a threshold per generator."""

    start: float
    trees: list[Node]
    thresholds: dict[int, float]

    def score(self, features: Column) -> Column:
        odds = reduce(Column.__add__, [t.expression(features) for t in self.trees], F.lit(self.start))
        return F.lit(1.0) / (1 + F.exp(-odds))

    def accepts(self, generator: Column, features: Column) -> Column:
        chosen = F.lit(False)
        for number, least in self.thresholds.items():
            chosen = F.when(generator == number, self.score(features) >= least).otherwise(chosen)
        return chosen


def _leaf(gradient: float, curve: float) -> float:
    return RATE * gradient / (curve + SMOOTHING)


def _worth(gradient: float, curve: float) -> float:
    return gradient * gradient / (curve + SMOOTHING)


def _split(sums: dict[str, dict[int, tuple[float, float]]]) -> tuple[float, str, int, list] | None:
    """The split of the highest gain: gain, feature, cut and both sides' sums."""
    best = None
    for name in FEATURES:
        values = sums.get(name, {})
        total = [sum(value[i] for value in values.values()) for i in (0, 1)]
        low = [0.0, 0.0]
        for cut in sorted(values)[:-1]:
            low = [a + b for a, b in zip(low, values[cut])]
            high = [a - b for a, b in zip(total, low)]
            if min(low[1], high[1]) < MIN_CURVE:
                continue
            gain = _worth(*low) + _worth(*high) - _worth(*total)
            if gain > (best[0] if best else 0.0) + MIN_GAIN:
                best = gain, name, cut, [low, high]
    return best


def _tree(cells: DataFrame, model: Model) -> Node:
    """A tree that follows the gradient of the log loss at the model's scores."""
    root, features = Node(), F.col("features")
    probability = model.score(features)
    weight = F.col("good") + F.col("bad")
    scored = cells.select(
        "features",
        (F.col("good") - weight * probability).alias("gradient"),
        (weight * probability * (1 - probability)).alias("curve"),
    )
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("name"), features[name].alias("value")) for name in FEATURES
        ]
    )
    for _ in range(DEPTH):
        leaves: dict[int, Node] = {}
        placed = scored.select(
            root.place(features, leaves).alias("node"), F.inline(pairs), "gradient", "curve"
        )
        # rounded, so that the order of the additions decides on no split
        found = placed.groupBy("node", "name", "value").agg(
            F.round(F.sum("gradient"), 6).alias("gradient"), F.round(F.sum("curve"), 6).alias("curve")
        )
        sums: dict[int, dict] = {}
        for row in found.collect():
            by_name = sums.setdefault(row.node, {})
            by_name.setdefault(row["name"], {})[row.value] = (row.gradient, row.curve)
        splits = {number: _split(by_name) for number, by_name in sums.items()}
        for number, split in splits.items():
            if split:
                _, name, cut, sides = split
                leaf = leaves[number]
                leaf.feature, leaf.cut = name, cut
                leaf.children = [Node(_leaf(*side)) for side in sides]
        if not any(splits.values()):
            break
    return root


def _thresholds(cells: DataFrame, model: Model, precision: float) -> dict[int, float]:
    """Per generator, the least score from which on held-back spans are precise enough."""
    score = model.score(F.col("features")).alias("score")
    found = cells.select(
        F.col("features.generator").alias("generator"), score, "held_good", "held_bad"
    )
    found = found.groupBy("generator", F.round("score", 4).alias("score")).agg(
        F.sum("held_good").alias("good"), F.sum("held_bad").alias("bad")
    )
    thresholds: dict[int, float] = {}
    counts: dict[int, list[int]] = {}
    for row in sorted(found.collect(), key=lambda row: -row.score):
        if row.score < MIN_SCORE:
            break
        held = counts.setdefault(row.generator, [0, 0])
        held[0] += row.good
        held[1] += row.bad
        if held[0] and held[0] >= precision * (held[0] + held[1]):
            # half a step of the rounding below, so that all of this score are at least that
            thresholds[row.generator] = row.score - 5e-5
    return thresholds


def learn(
    scanned: DataFrame, rounds: int = ROUNDS, precision: float = MIN_PRECISION
) -> Model | None:
    """Trees and thresholds from the proposed spans of ``scan``'s rows, or None."""
    held = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(3)) == 0
    each = scanned.select(held.alias("held"), F.explode("proposed").alias("one"))
    cells = each.groupBy(F.col("one.features").alias("features")).agg(
        *[
            F.count_if(condition & side).alias(prefix + name)
            for prefix, side in (("", ~F.col("held")), ("held_", F.col("held")))
            for name, condition in (("good", F.col("one.known")), ("bad", ~F.col("one.known")))
        ]
    )
    cells = stage(cells, "cells").coalesce(1)
    good, bad = cells.agg(F.sum("good"), F.sum("bad")).first()
    if not good or not bad:
        return None
    model = Model(math.log(good / bad), [], {})
    for _ in range(rounds):
        tree = _tree(cells, model)
        if tree.feature is None:
            break
        model.trees.append(tree)
    model.thresholds = _thresholds(cells, model, precision)
    return model


# --- results ----------------------------------------------------------------------------


def _listed(spans: Column, kind: str, score) -> Column:
    return F.transform(
        spans,
        lambda one: F.struct(
            F.lit(kind).alias("kind"),
            one["start"].alias("start"),
            one["end"].alias("end"),
            score(one).alias("score"),
        ),
    )


def _added(model: Model, number: int) -> Column:
    """The spans of a generator that no strict pattern keeps, but the trees accept."""

    def accepted(one):
        wanted = (one["generator"] == number) & ~one["known"]
        return wanted & model.accepts(one["generator"], one["features"])

    return F.filter("proposed", accepted)


def _spans(model: Model | None) -> Column:
    """All spans: ``kind, start, end, score`` by kind as listed, then by start."""
    parts = [_listed(F.col("strict")[kind], kind, lambda one: F.lit(1.0)) for kind in BASE_KINDS]
    for number, kind in enumerate(GENERATORS):
        if model is not None and number in model.thresholds:
            spans = _added(model, number)
            parts.append(_listed(spans, kind, lambda one: model.score(one["features"])))
    return F.concat(*parts)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, by kind as in ``KINDS``, then start.

    A span has ``kind, start, end`` and its ``score``, 1 where a strict pattern found it.
    """
    scanned = stage(scan(docs, doc_id, text).drop("_text"), "personal-data")
    return scanned.select("doc_id", _spans(learn(scanned)).alias("spans"))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text`` with every span replaced by its kind in brackets.

    Of spans that overlap, the one that starts first, or else is longer, names them all.
    """
    scanned = stage(scan(docs, doc_id, text), "personal-data")
    model = learn(scanned.select("doc_id", "proposed"))
    # by start, then the longest
    keyed = F.transform(
        _spans(model),
        lambda one: F.struct(one["start"], (-one["end"]).alias("less"), one["end"], one["kind"]),
    )
    rows = scanned.select("doc_id", "_text", F.array_sort(keyed).alias("_spans"))

    def step(held, one):
        kept = F.struct(
            one["start"].alias("start"), one["end"].alias("end"), one["kind"].alias("kind")
        )
        apart = one["start"] >= held["end"]
        return F.struct(
            F.greatest(held["end"], one["end"]).alias("end"),
            F.concat(held["spans"], F.when(apart, F.array(kept)).otherwise(none)).alias("spans"),
            F.concat(
                held["ends"], F.when(apart, F.array(held["end"])).otherwise(no_ends)
            ).alias("ends"),
        )

    none = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")
    no_ends = F.array().cast("array<bigint>")
    begin = F.struct(
        F.lit(0).cast("long").alias("end"), none.alias("spans"), no_ends.alias("ends")
    )
    rows = rows.withColumn("_merged", F.aggregate("_spans", begin, step))
    told = F.zip_with(
        "_merged.spans",
        "_merged.ends",
        lambda one, end: F.concat(
            F.substring("_text", (end + 1).cast("int"), (one["start"] - end).cast("int")),
            F.lit("["),
            F.upper(one["kind"]),
            F.lit("]"),
        ),
    )
    rest = F.substring(F.col("_text"), (F.col("_merged.end") + 1).cast("int"), F.char_length("_text"))
    return rows.select("doc_id", F.concat(F.array_join(told, ""), rest).alias("text"))
