"""The filter audit against a walk through every order, document by document."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import pyarrow as pa
import pytest

from shelfcast.llm import filteraudit

WORDS = " ".join(f"w{i}" for i in range(120))
DOCS = [
    (1, WORDS, "en"),
    (2, WORDS, "en"),
    (2, WORDS, "en"),
    (None, WORDS, "de"),
    (3, None, None),
    (4, "", ""),
    (5, "SHOUT " * 130, "en"),
    (6, "SHOUT " * 130, "de"),
    (7, f"{WORDS}\x0b{WORDS} 5%", "de"),
    (8, "é " * 30, "fr"),
    (9, " ".join(f"{i}" for i in range(60_000)) + " \x1cend", "fr"),
    (0, "SHOUT " * 130, "xx"),
]
LABELS = [(1, 1, 0), (2, 1, None), (2, 0, 1), (5, 0, 1), (6, None, None), (None, 1, 1), (99, 1, 1)]


def _failing(docs):
    first = {}
    for name, text, _ in docs:
        if name is not None:
            first[text or ""] = min(name, first.get(text or "", name))
    for name, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": name is not None and first.get(text, name) < name,
        }
        yield name, part or "", {letter for letter, failed in fails.items() if failed}


def _walk(docs, labels):
    """What the audit returns, by applying every order to every document."""
    good = {name for name, quality, _ in labels if quality == 1 and name is not None}
    toxic = {name for name, _, poison in labels if poison == 1 and name is not None}
    counts, parts = Counter(), set()
    for name, part, fails in _failing(docs):
        parts.add(part)
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, letter in enumerate(order, 1):
                key = (part, order, step)
                counts[key, "unique"] += fails == {letter}
                if letter in fails and not gone:
                    gone = True
                    counts[key, "removed"] += 1
                    counts[key, "good"] += name in good
                    counts[key, "toxic"] += name in toxic
                    counts[part, letter] += 1
                elif letter in fails:
                    counts[key, "redundant"] += 1
                counts[key, "kept"] += not gone
    for part in parts:
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                key = (part, order, step)
                names = ("kept", "removed", "redundant", "unique", "good", "toxic")
                yield (*key, *(counts[key, name] for name in names), counts[part, letter])


def _tables(spark, docs=DOCS, labels=LABELS):
    # names of the operator's own columns must not get in its way
    rows = [(*doc, 7, "clash", True) for doc in docs]
    schema = "doc_id long, text string, lang string, mask int, text_hash string, good boolean"
    return (
        spark.createDataFrame(rows, schema),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


@pytest.mark.parametrize("hot", [1000, 5])
def test_audit_is_that_of_walking_every_order(spark, monkeypatch, hot):
    monkeypatch.setattr(filteraudit, "HOT_SHARE", hot)
    docs, labels = _tables(spark)
    found = filteraudit.audit(filteraudit.marks(docs.repartition(3), labels))
    assert sorted(map(tuple, found.collect())) == sorted(_walk(DOCS, LABELS))


def test_audit_of_empty_tables(spark):
    docs, labels = _tables(spark)
    none = docs.where("false")
    assert filteraudit.audit(filteraudit.marks(none, labels)).collect() == []
    unlabelled = filteraudit.audit(filteraudit.marks(docs, labels.where("false")))
    assert sorted(map(tuple, unlabelled.collect())) == sorted(_walk(DOCS, []))


def test_long_texts_are_cut_into_words_whole(monkeypatch):
    raw = b"ab  cd\x0b" * 50 + b"x" * 500
    for size in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(filteraudit, "CHUNK_BYTES", size)
        assert filteraudit._word_counts(raw) == (101, 3)


def test_sums_of_many_parts_leave_the_task_early(monkeypatch):
    monkeypatch.setattr(filteraudit, "MAX_HELD", 2)
    parts = ["a", "b", "a", "c", "d", "a", "b"]
    batch = pa.RecordBatch.from_pylist(
        [dict(part=p, salt=0, mask=3, good=True, toxic=False) for p in parts]
    )
    batches = [*filteraudit._sums("ABCDE")([batch])]
    assert max(one.num_rows for one in batches) == 2
    table = pa.Table.from_batches(batches).sort_by("part")
    merged = pa.Table.from_batches([*filteraudit._merge(table.to_batches())])
    assert dict(zip(*merged.select(["part", "rows"]).to_pydict().values())) == Counter(parts)


def test_fields_of_large_sums_do_not_run_over():
    every, removed = filteraudit.outcomes(0b10001)
    once = filteraudit.fields(every, 1, 1800)
    rows = (1 << 48) - 1
    assert (filteraudit.fields(every * rows, rows, 1800) == once * rows).all()
    assert (filteraudit.fields(removed, 1, 600) == once[600:1200]).all()
    with pytest.raises(OverflowError):
        filteraudit.fields(0, rows + 1, 1800)
