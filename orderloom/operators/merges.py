"""Row-level upkeep as frame transformations: what a table holds after a delete, an upsert or a merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.calendar import instant_literal


def in_range(ts_column: str, start_iso: str, end_iso: str) -> Column:
    ts = F.col(ts_column)
    return (ts >= instant_literal(start_iso)) & (ts < instant_literal(end_iso))


def delete_between(rows: DataFrame, ts_column: str, start_iso: str, end_iso: str) -> DataFrame:
    """The rows outside ``[start, end)``; rows without a time stay."""
    return rows.where(~F.coalesce(in_range(ts_column, start_iso, end_iso), F.lit(False)))


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def upsert_by_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` after updating the rows whose keys ``source`` holds and inserting the others.

    Columns that only the target has keep their value on update and are null on insert. A null key
    matches nothing, so such a source row is inserted. A target row that several source rows match
    raises.

    Updates are a left join from the target and inserts an anti join, not one full outer join: Spark can
    then broadcast a small source and leave the target where it is, or split a hot key of the target.
    Target keys are filtered by the source's and made distinct before the anti join.
    """
    keys = list(keys)
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"the target has no column {', '.join(unknown)}")
    absent = [k for k in keys if k not in source.columns]
    if absent:
        raise ValueError(f"the source has no key column {', '.join(absent)}")

    keyed = _all([F.col(k).isNotNull() for k in keys])
    copies = source.where(keyed).groupBy(*keys).agg(F.count(F.lit(1)).alias("key_copies"))

    t = target.alias("t")
    s = source.where(keyed).join(copies, keys).alias("s")
    joined = t.join(s, _all([F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]), "left")
    several = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    matched = F.when(F.col("s.key_copies") > 1, several).otherwise(F.col("s.key_copies").isNotNull())

    def updated(name: str) -> Column:
        old = F.col(f"t.{name}")
        if name not in source.columns:
            return old.alias(name)
        kind = target.schema[name].dataType
        return F.when(matched, F.col(f"s.{name}").cast(kind)).otherwise(old).alias(name)

    def inserted(field) -> Column:
        value = F.col(field.name) if field.name in source.columns else F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    held = target.select(*keys).join(copies.select(*keys), keys, "left_semi").distinct()
    added = source.join(held, keys, "left_anti").select(*[inserted(f) for f in target.schema.fields])
    return joined.select(*[updated(name) for name in target.columns]).unionByName(added)


def unmatched(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source rows an insert-only merge adds: those whose keys the target does not hold."""
    held = target.select(*keys).distinct()
    return source.join(held, list(keys), "left_anti")
