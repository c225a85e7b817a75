"""Row counts, samples and key checks of every stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import quality
from shelfcast.plans.features import FeatureTables
from shelfcast.plans.ingest import StarSchema

# The key that each looked-up table must not repeat.
KEYS = {
    "dim_item": ("item_id",),
    "dim_store": ("store_id",),
    "oil": ("date",),
    "transactions": ("date", "store_id"),
    "holidays": ("date",),
    "weather": ("date", "city_norm"),
}


def stages(tables: StarSchema, features: FeatureTables) -> dict[str, DataFrame]:
    return {
        name: getattr(part, name)
        for part in (tables, features)
        for name in part.__dataclass_fields__
    }


def row_counts(tables: StarSchema, features: FeatureTables, **more: DataFrame) -> DataFrame:
    """Rows per stage; enriched sales beyond the fact's count show a fan-out."""
    return quality.stage_row_counts({**stages(tables, features), **more})


def fan_out(tables: StarSchema, features: FeatureTables) -> DataFrame:
    """Per looked-up table, how many of its keys repeat."""
    parts = stages(tables, features)
    return quality.stage_row_counts(
        {name: quality.repeated_keys(parts[name], *keys) for name, keys in KEYS.items()}
    ).withColumnRenamed("row_count", "repeated_keys")


def check_unique(tables: StarSchema, features: FeatureTables) -> None:
    """Fail if a looked-up table would multiply sales rows."""
    repeated = fan_out(tables, features).filter(F.col("repeated_keys") > 0).collect()
    if repeated:
        raise ValueError(f"repeated keys: {[row.asDict() for row in repeated]}")


def fingerprints(tables: StarSchema, features: FeatureTables) -> DataFrame:
    """Rows and fingerprint per stage, equal for copies whatever their order or place."""
    return quality.fingerprints(stages(tables, features))


def check_copies(left: dict[str, DataFrame], right: dict[str, DataFrame]) -> None:
    """Fail if a table and its copy of the same name do not hold the same rows."""
    both = {f"left {name}": table for name, table in left.items()}
    both |= {f"right {name}": table for name, table in right.items()}
    rows = quality.fingerprints(both).collect()
    found = {row.stage: (row.row_count, row.fingerprint) for row in rows}
    differ = [name for name in left if found[f"left {name}"] != found.get(f"right {name}")]
    if differ:
        raise ValueError(f"copies that differ: {differ}")
