"""Quality rules: base counts, and a learned decision list of threshold conjunctions.

Sequential covering: a rule grows one condition at a time by FOIL's gain, is cut back to
the prefix that does best on rows it did not grow on, and is accepted if it is precise
there; the rows it covers leave, and the next rule starts. What is learned from are
counts of good and bad labelled rows per feature and quantile bin, gathered by Spark; the
driver sees at most ``features x bins`` rows at a time. The rules come out as an ordered
conditional expression. All of it is built of DataFrame functions.

Defined results: a null text has no words and fails the base. Labels that are null are
ignored, and so are ids whose labels disagree. Without labelled rows of both kinds there
are no rules, and the base decides alone. Rows may repeat; each is judged by itself.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import stage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BINS = 24
MAX_RULES = 10
MAX_CONDITIONS = 3
MIN_PRECISION = 0.9
MIN_COVERED = 5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "words",
    "symbols_per_word",
    "repeat_share",
    "duplicate_line_share",
    "word_length",
    "distinct_share",
    "capital_share",
    "digit_share",
    "exclamations_per_word",
    "words_per_line",
)

_BLANKS = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self) -> Column:
        value = F.col(f"features.{self.feature}")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _both(left: Column, right: Column) -> Column:
    return F.xxhash64(left, right)


def _repeated_words(hashes: Column) -> list[tuple[str, Column]]:
    """Columns that lead from word hashes to the words in windows of three that occur twice.

    Windows are sorted by their hash, with their place; equal neighbours give the places.
    """
    size = F.greatest(F.size(hashes) - 2, F.lit(0))
    pair = F.zip_with(F.slice(hashes, 1, size), F.slice(hashes, 2, size), _both)
    ordered = F.sort_array(
        F.transform(
            F.zip_with(pair, F.slice(hashes, 3, size), _both),
            lambda window, place: F.struct(window.alias("w"), place.alias("at")),
        )
    )
    rest = F.greatest(F.size("_ordered") - 1, F.lit(0))
    twins = F.zip_with(
        F.slice("_ordered", 1, rest),
        F.slice("_ordered", 2, rest),
        lambda a, b: F.when(a["w"] == b["w"], F.array(a["at"], b["at"])),
    )
    places = F.flatten(F.filter(twins, lambda one: one.isNotNull()))
    spread = F.flatten(F.transform("_places", lambda at: F.array(at, at + 1, at + 2)))
    return [
        ("_ordered", ordered),
        ("_places", F.array_distinct(places)),
        ("n_repeat_words", F.size(F.array_distinct(spread)).cast("long")),
    ]


def measure(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", whole: bool = False
) -> DataFrame:
    """``doc_id``, the base counts (``BASE``) and a struct ``features`` of doubles.

    ``whole`` adds ``_row``, a struct of the document's own columns.
    """
    carried = ["doc_id", "_row"] if whole else ["doc_id"]
    out = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.struct("*").alias("_row"),
        F.coalesce(text, F.lit("")).alias("_text"),
    )
    lines = F.filter(F.split("_text", "\n"), lambda line: F.trim(line, F.lit(" \t\n\v\f\r")) != "")
    out = out.select(
        *carried,
        F.array_remove(F.split("_text", _BLANKS), "").alias("_words"),
        lines.alias("_lines"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit("[A-Z]")).alias("_capitals"),
        F.regexp_count("_text", F.lit("[0-9]")).alias("_digits"),
        F.regexp_count("_text", F.lit("!")).alias("_exclamations"),
    )
    out = out.select(
        *carried,
        "n_symbols",
        "_capitals",
        "_digits",
        "_exclamations",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.transform("_words", lambda word: F.xxhash64(word)).alias("_hashes"),
        F.size("_lines").cast("long").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    for name, column in _repeated_words(F.col("_hashes")):
        out = out.withColumn(name, column)
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    n_lines = F.greatest("_n_lines", F.lit(1))
    shares = (
        F.col("n_words"),
        F.col("n_symbols") / words,
        F.col("n_repeat_words") / words,
        F.col("n_dup_lines") / n_lines,
        F.col("word_chars") / words,
        F.size(F.array_distinct("_hashes")) / words,
        F.col("_capitals") / chars,
        F.col("_digits") / chars,
        F.col("_exclamations") / words,
        F.col("n_words") / n_lines,
    )
    features = [share.cast("double").alias(name) for name, share in zip(FEATURES, shares)]
    return out.select(*carried, *BASE, F.struct(*features).alias("features"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def _gain(bad: int, good: int, bad_before: int, good_before: int) -> float:
    if not bad:
        return -math.inf
    before = math.log2(bad_before / (bad_before + good_before))
    return bad * (math.log2(bad / (bad + good)) - before)


class _Learner:
    """Sequential covering over labelled rows: ``bad``, ``growing`` and ``bins``."""

    def __init__(self, rows: DataFrame, thresholds: list[list[float]]):
        self.rows, self.thresholds = rows, thresholds

    def _inside(self, rule: list[tuple[int, bool, int]]) -> Column:
        held = F.lit(True)
        for feature, above, bin_ in rule:
            value = F.element_at("bins", feature + 1)
            held &= value > bin_ if above else value <= bin_
        return held

    def _histogram(self, rows: DataFrame) -> dict[int, dict[int, tuple[int, int]]]:
        each = rows.select("bad", F.posexplode("bins").alias("feature", "bin"))
        counts = each.groupBy("feature", "bin").agg(
            F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")
        )
        found: dict[int, dict[int, tuple[int, int]]] = {}
        for row in counts.collect():
            found.setdefault(row.feature, {})[row.bin] = (row.bad, row.good)
        return found

    def _best(self, rows: DataFrame) -> tuple[float, tuple[int, bool, int] | None, bool]:
        """The condition of the highest gain, and whether it leaves no good row."""
        best, chosen, pure = 0.0, None, True
        for feature, bins in sorted(self._histogram(rows).items()):
            all_bad = sum(bad for bad, _ in bins.values())
            all_good = sum(good for _, good in bins.values())
            if not all_bad:
                return 0.0, None, True
            bad = good = 0
            for bin_ in range(len(self.thresholds[feature])):
                bad, good = (a + b for a, b in zip((bad, good), bins.get(bin_, (0, 0))))
                for above in (False, True):
                    inside = (all_bad - bad, all_good - good) if above else (bad, good)
                    gain = _gain(*inside, all_bad, all_good)
                    if gain > best + 1e-9 and inside[0] >= MIN_COVERED:
                        best, chosen = gain, (feature, above, bin_)
                        pure = inside[1] == 0
        return best, chosen, pure

    def _pruned(self, rows: DataFrame, rule: list) -> tuple[list, bool]:
        """The best prefix on the held-back rows, and whether it is precise there."""
        counts = []
        for upto in range(1, len(rule) + 1):
            held = self._inside(rule[:upto])
            counts += [
                F.count_if(held & F.col("bad") & ~F.col("growing")).alias(f"bad{upto}"),
                F.count_if(held & ~F.col("bad") & ~F.col("growing")).alias(f"good{upto}"),
            ]
        found = rows.agg(*counts).first().asDict()
        worth = [
            ((bad - good) / (bad + good) if bad + good else -1.0, bad, -upto)
            for upto in range(1, len(rule) + 1)
            for bad, good in [(found[f"bad{upto}"], found[f"good{upto}"])]
        ]
        value, bad, upto = max(worth)
        return rule[:-upto], bad > 0 and value >= 2 * MIN_PRECISION - 1

    def rules(self) -> list[Rule]:
        left, found = self.rows, []
        for _ in range(MAX_RULES):
            rule: list[tuple[int, bool, int]] = []
            while len(rule) < MAX_CONDITIONS:
                rows = left.where(F.col("growing") & self._inside(rule))
                _, condition, pure = self._best(rows)
                if condition is None:
                    break
                rule.append(condition)
                if pure:
                    break
            if not rule:
                break
            rule, good = self._pruned(left, rule)
            if not good:
                break
            found.append(self._settled(left, rule))
            left = left.where(~self._inside(rule))
        return found

    def _settled(self, rows: DataFrame, rule: list) -> Rule:
        """The rule with its lower bounds half-way to the bad rows (all but 2 %) inside it.

        A quantile bin begins where the good rows end; that close to them, the next good
        row would fall on the wrong side.
        """
        names = [FEATURES[feature] for feature, _, _ in rule]
        edges = rows.where(F.col("bad") & self._inside(rule)).agg(
            *[
                F.percentile_approx(f"features.{name}", 0.02 if above else 0.98, 1000)
                for name, (_, above, _) in zip(names, rule)
            ]
        )
        found = []
        for name, (feature, above, bin_), edge in zip(names, rule, edges.first()):
            cut = self.thresholds[feature][bin_]
            found.append(Condition(name, above, (cut + edge) / 2 if above else cut))
        return tuple(found)


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many cuts lie below the value."""
    return F.size(F.filter(F.array(*[F.lit(float(cut)) for cut in cuts]), lambda cut: cut < value))


def learn(measured: DataFrame, labels: DataFrame, quality: str = "quality") -> list[Rule]:
    """Rules for bad rows from labels 1 (good) and 0 (bad) of some ids."""
    known = labels.where(F.col(quality).isNotNull()).groupBy("doc_id")
    known = known.agg(F.min(quality).alias("low"), F.max(quality).alias("high"))
    known = known.where("low = high").select("doc_id", (F.col("low") == 0).alias("bad"))
    rows = measured.where(~base_failed()).join(known, "doc_id")
    rows = stage(rows.select("doc_id", "bad", "features"), "labelled")
    shares = [number / BINS for number in range(1, BINS)]
    cuts = rows.agg(
        *[F.percentile_approx(f"features.{name}", shares).alias(name) for name in FEATURES],
        F.count_if("bad").alias("_bad"),
        F.count_if(~F.col("bad")).alias("_good"),
    ).first()
    if not cuts["_bad"] or not cuts["_good"]:
        return []
    thresholds = [sorted(set(cuts[name])) for name in FEATURES]
    bins = [_bin(F.col(f"features.{name}"), cuts) for name, cuts in zip(FEATURES, thresholds)]
    growing = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(3)) > 0
    binned = rows.select("bad", growing.alias("growing"), "features", F.array(*bins).alias("bins"))
    binned = stage(binned, "bins")
    return _Learner(binned, thresholds).rules()


def verdict(rules: list[Rule]) -> Column:
    """The first rule that holds, as text; null if none does."""
    chosen = F.lit(None).cast("string")
    for rule in reversed(rules):
        held = rule[0].holds()
        for condition in rule[1:]:
            held &= condition.holds()
        chosen = F.when(held, F.lit(" and ".join(map(str, rule)))).otherwise(chosen)
    return chosen


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"):
    """``measure``'s columns with ``base_failed``, ``rule`` and ``kept``."""
    measured = stage(measure(docs, doc_id, text), "measured")
    rules = learn(measured, labels)
    rule = verdict(rules)
    return measured.select(
        "*",
        base_failed().alias("base_failed"),
        rule.alias("rule"),
        (~base_failed() & rule.isNull()).alias("kept"),
    )


def keep(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"):
    """The rows of ``docs`` that are kept, with its columns.

    Measuring costs several times what storing does, so the rows are stored with what was
    measured, and the rules that are learnt from it are applied to the stored table.
    """
    rows = stage(measure(docs, doc_id, text, whole=True), "measured")
    kept = rows.where(~base_failed() & verdict(learn(rows, labels)).isNull())
    return kept.select(*[F.col("_row")[name].alias(name) for name in docs.columns])
