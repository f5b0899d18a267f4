"""Tables in Spark's catalogue: how a path becomes one, and how its content switches to new folders.

The last folder of a path is the table's name, and the folder above it is its database. Tables are external: a write
makes a new folder first, and a statement of the catalogue then points the table, or one of its months, to it. A job that
fails before that leaves the table as it was, and months that are not changed keep their files.

What a catalogue knows lasts as long as it does: with a metastore for good, in memory until the session ends.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.session import folders, remove

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder that Spark gives to rows without a partition value


def _split(path: str) -> tuple[str, str]:
    root, _, name = path.rstrip("/").rpartition("/")
    return root, name


def identifier(path: str) -> str:
    """The name of a path's table in SQL."""
    root, name = _split(path)
    return f"`shop_{hashlib.sha256(root.encode()).hexdigest()[:12]}`.`{name}`"


def exists(spark: SparkSession, path: str) -> bool:
    return spark.catalog.tableExists(identifier(path))


def create(spark: SparkSession, path: str, schema: T.StructType, partition: str | None) -> bool:
    """Create an empty table from its declared types unless the catalogue has it; True when it was created."""
    if exists(spark, path):
        return False
    if folders(spark, path):
        raise LookupError(f"there are files at {path} of which this session's catalogue knows nothing")
    root, _ = _split(path)
    database, _, _ = identifier(path).partition(".")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    # rows of a table without months lie in a folder of their own, so that no other version is below it
    place = f"PARTITIONED BY (`{partition}`) LOCATION '{path}'" if partition else f"LOCATION '{path}/load={uuid.uuid4().hex}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    spark.sql(f"CREATE TABLE {identifier(path)} ({columns}) USING parquet {place}")
    return True


def read(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        raise LookupError(f"there is no table at {path}")
    return spark.table(identifier(path))


@dataclass
class Written:
    """Rows in a folder that no table names yet."""

    folder: str
    rows: int
    parts: list[str]  # the folder names of the partition values that got rows


def _dealt(rows: DataFrame, partition: str | None) -> DataFrame:
    """The rebalance hint lets Spark split a partition that is far larger than the others and merge small ones, so
    a month with a third of all rows is not one task's work."""
    return rows.hint("rebalance", partition).sortWithinPartitions(partition) if partition else rows


def _clustered(rows: DataFrame, partition: str | None, order: Sequence[str], files: int | None) -> DataFrame:
    """Rows cut into ranges of partition and order, and sorted in them: each file of a large month holds a range of its
    own, which its statistics tell, so that readers of a few values skip the others. The rows are sampled first."""
    keys = [*([partition] if partition else []), *order]
    return rows.repartitionByRange(*([files] if files else []), *keys).sortWithinPartitions(*keys)


def _counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write(
    spark: SparkSession, rows: DataFrame, path: str, partition: str | None, order: Sequence[str] = (), files: int | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> Written:
    """Write rows to a new folder. They are counted as they are written, and not read again. ``finish`` gives them their columns after they are
    dealt out, row by row."""
    dealt = _clustered(rows, partition, order, files) if order else _dealt(rows, partition)
    dealt, seen = _counted(finish(dealt) if finish else dealt)
    folder = f"{path}/load={uuid.uuid4().hex}"
    writer = dealt.write
    (writer.partitionBy(partition) if partition else writer).parquet(folder)
    prefix = f"{partition}="
    parts = [name.removeprefix(prefix) for name in folders(spark, folder) if name.startswith(prefix)] if partition else []
    return Written(folder, seen.get["rows"], parts)


def append(
    spark: SparkSession, rows: DataFrame, path: str, partition: str | None, finish: Callable[[DataFrame], DataFrame] | None = None
) -> int:
    """Add rows to the table's own folders; returns how many. They are seen when all tasks have written. ``finish`` as in ``write``."""
    table = read(spark, path)
    dealt = _dealt(rows, partition)
    dealt, seen = _counted((finish(dealt) if finish else dealt).select(*table.columns))
    dealt.write.insertInto(identifier(path))
    return seen.get["rows"]


def parts(spark: SparkSession, path: str) -> list[str]:
    """The partition values that the table has, as their folders are named."""
    return [row[0].partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {identifier(path)}").collect()]  # one per month


def _spec(partition: str, part: str) -> str:
    return f"PARTITION (`{partition}` = {'null' if part == NO_VALUE else repr(part)})"


def switch(spark: SparkSession, path: str, partition: str | None, changes: dict[str, str | None]) -> None:
    """Point the partitions of ``changes`` to new folders, or drop those that have none; ``{"": folder}`` for a whole table."""
    table = identifier(path)
    if not partition:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{changes['']}'")
        return
    held = set(parts(spark, path))
    fresh = [f"{_spec(partition, part)} LOCATION '{folder}'" for part, folder in changes.items() if folder and part not in held]
    if fresh:
        spark.sql(f"ALTER TABLE {table} ADD {' '.join(fresh)}")
    for part, folder in changes.items():
        if part in held and folder:
            spark.sql(f"ALTER TABLE {table} {_spec(partition, part)} SET LOCATION '{folder}'")
    gone = [_spec(partition, part) for part, folder in changes.items() if not folder and part in held]
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP {', '.join(gone)}")


def places(written: Written, partition: str | None, only: Sequence[str] | None = None) -> dict[str, str]:
    """Where the partitions of written rows lie, for ``switch``."""
    if not partition:
        return {"": written.folder}
    return {part: f"{written.folder}/{partition}={part}" for part in written.parts if only is None or part in only}


def _locations(spark: SparkSession, path: str, partition: str | None) -> set[str]:
    """The folders that the table names."""
    specs = [_spec(partition, part) for part in parts(spark, path)] if partition else [""]
    found = set()
    for spec in specs:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {identifier(path)} {spec}").collect()
        found.add(next(row["data_type"] for row in rows if row["col_name"] == "Location").rpartition(":")[2].rstrip("/"))
    return found


def purge(spark: SparkSession, path: str, partition: str | None = None) -> int:
    """Delete the folders below a table that it does not name any more; returns their number."""
    used = _locations(spark, path, partition)
    bare = path.rstrip("/").rpartition(":")[2]
    old = []
    for name in folders(spark, path):
        if partition and name.startswith("load="):
            inner = folders(spark, f"{path}/{name}")
            left = [part for part in inner if f"{bare}/{name}/{part}" not in used]
            old += [f"{path}/{name}"] if len(left) == len(inner) else [f"{path}/{name}/{part}" for part in left]
        elif f"{bare}/{name}" not in used:
            old.append(f"{path}/{name}")
    for folder in old:
        remove(spark, folder)
    return len(old)


def note(spark: SparkSession, path: str, key: str, value: str | None = None) -> str | None:
    """A property that the table carries in the catalogue: set it, or read it."""
    if value is not None:
        spark.sql(f"ALTER TABLE {identifier(path)} SET TBLPROPERTIES ('{key}' = '{value}')")
        return value
    held = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {identifier(path)}").collect()}
    return held.get(key)
