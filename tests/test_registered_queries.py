"""Every registered query against its SQL counterpart, row for row.

TEST_SF picks the tables: 0.001 by default, 0.01 for a fuller run.
"""

import os
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from orderloom.plans.catalogue import QUERIES
from orderloom.plans.oracle import ORACLE

SF_DIR = f"/root/testdata/sf{os.environ.get('TEST_SF', '0.001')}"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    ours = Counter(tuple(row) for row in result.select(*columns).collect())

    duck.execute(ORACLE[name])
    labels = [d[0] for d in duck.description]
    kinds = {d[0]: str(d[1]) for d in duck.description}
    assert sorted(labels) == columns
    order = [labels.index(c) for c in columns]
    rows = duck.fetchall()
    theirs = Counter(tuple(row[i] for i in order) for row in rows)

    assert rows, "an empty result proves nothing"
    assert not any(isinstance(v, Decimal) for row in rows for v in row), "exact numbers are shown as double"
    family = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for column, kind in result.dtypes:
        assert family[kind] == kinds[column] or kinds[column] == '"NULL"', (column, kind, kinds[column])
    assert ours == theirs, f"only ours: {list((ours - theirs).items())[:3]}, only theirs: {list((theirs - ours).items())[:3]}"
