"""Secrets in texts, and how widely each is shared over the corpus.

Candidates are the spans of four patterns. ``assign``, ``access`` and ``hex`` are reported
wherever they match. ``opaque`` (long mixed runs of letters and digits) would report many
harmless strings, so the corpus decides: a candidate's hash is counted by distinct
repositories and distinct owners, and one that more than ``MAX_OWNERS`` owners show is a
widely copied example. Every candidate is called ``live`` if few owners show it and
``copied`` otherwise; opaque spans are reported if they are live.

Counting takes distinct (hash, repository, owner) triples first and partial sums next, so
a string on every page costs one row per task and owner. Values never leave the scan, only
their hashes do.

Defined results: a null text is empty. A null repository or owner counts as one nameless
one. Rows may repeat; each gets its own spans, a repeated row adds no owner.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import stage

#: In the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "opaque")
BASE_KINDS = KINDS[:3]
MAX_OWNERS = 2
MIN_ASSIGN, MIN_ACCESS, MIN_HEX, MIN_OPAQUE = 12, 18, 16, 20

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_OPAQUE = re.compile(r"[A-Za-z0-9_-]+")
# what a text must hold to be looked at by the patterns above
_HINT = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{14}"
    r"|[0-9a-f]{16}|[A-Za-z0-9_-]{20}"
)

CANDIDATE = "array<struct<start:int,end:int,kind:int,hash:string>>"


def _opaque(value: str) -> bool:
    """Letters of both cases and several digits, as keys have and words do not."""
    digits = sum(map(str.isdigit, value))
    return (
        len(value) >= MIN_OPAQUE
        and digits >= 3
        and any("a" <= c <= "z" for c in value)
        and any("A" <= c <= "Z" for c in value)
    )


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """``start, end, kind, value`` of all candidates, by start and then by kind."""
    found = [
        (m.start(), m.end(), 0, m.group(2))
        for m in _ASSIGN.finditer(text)
        if len(m.group(2)) >= MIN_ASSIGN
    ]
    for kind, pattern, least in ((1, _ACCESS, MIN_ACCESS), (2, _HEX, MIN_HEX)):
        found += [
            (m.start(), m.end(), kind, m.group())
            for m in pattern.finditer(text)
            if m.end() - m.start() >= least
        ]
    taken = {(start, end) for start, end, _, _ in found}
    for m in _OPAQUE.finditer(text):
        if _opaque(m.group()) and not any(a < m.end() and m.start() < b for a, b in taken):
            found.append((m.start(), m.end(), 3, m.group()))
    return sorted(found)


def _hash(value: str) -> str:
    return hashlib.blake2b(value.encode("utf-8", "replace"), digest_size=16).hexdigest()


def _scan(batches):
    for batch in batches:
        text = batch.column(batch.num_columns - 1)
        hint = pc.match_substring_regex(text, _HINT).fill_null(False)
        rows = [[]] * len(text)
        for place in pc.indices_nonzero(hint).to_pylist():
            rows[place] = [
                {"start": start, "end": end, "kind": kind, "hash": _hash(value)}
                for start, end, kind, value in candidates(text[place].as_py())
            ]
        kept = batch.columns[:-1]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(rows, _CANDIDATES)], [*batch.schema.names[:-1], "candidates"]
        )


_CANDIDATES = pa.list_(
    pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("hash", pa.string())]
    )
)


def ownership(each: DataFrame) -> DataFrame:
    """``hash, repositories, owners`` of rows ``hash, repository, owner``."""
    pairs = each.select("hash", "repository", "owner").distinct()
    shown = F.struct(F.lit(0).alias("of"), "repository", "owner")
    by_owner = F.struct(F.lit(1).alias("of"), F.lit("").alias("repository"), "owner")
    # one row per thing to count, so that both counts come from one pass of partial sums
    things = pairs.select("hash", F.explode(F.array(shown, by_owner)).alias("thing")).distinct()
    return things.groupBy("hash").agg(
        F.count_if(F.col("thing.of") == 0).alias("repositories"),
        F.count_if(F.col("thing.of") == 1).alias("owners"),
    )


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    repository: str = "source",
    owner: str = "source",
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array by start and then by kind.

    A span has ``start``, ``end`` (code points, end exclusive), ``kind``, ``hash``,
    ``repositories``, ``owners`` and ``live``.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.col(text).alias("text"),
    )
    schema = rows.drop("text").schema
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    found = rows.mapInArrow(_scan, f"{names}, candidates {CANDIDATE}")
    # ids may repeat, so spans are put together by a number of the stored row
    found = found.withColumn("row", F.monotonically_increasing_id())
    found = stage(found, "candidates")
    each = found.select(
        "row", "repository", "owner", F.explode("candidates").alias("one")
    ).select("row", "repository", "owner", "one.*")
    judged = each.drop("repository", "owner").join(ownership(each), "hash")
    kinds = F.array(*map(F.lit, KINDS))
    span = F.struct(
        "start",
        "end",
        F.col("kind").alias("number"),
        F.get(kinds, F.col("kind")).alias("kind"),
        "hash",
        "repositories",
        "owners",
        (F.col("owners") <= max_owners).alias("live"),
    )
    # a null element drops out of the list: opaque strings that are widely copied
    told = F.when((F.col("kind") < len(BASE_KINDS)) | (F.col("owners") <= max_owners), span)
    spans = judged.groupBy("row").agg(F.sort_array(F.collect_list(told)).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return found.select("doc_id", "row").join(spans, "row", "left").select(
        "doc_id", F.coalesce("spans", none).alias("spans")
    )
