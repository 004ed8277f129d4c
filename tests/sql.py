"""Runs a registered query and its SQL over the same tables and compares all rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

SF = "/root/testdata/sf0.001"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), Counter(repr([r[k] for k in order]) for r in rows)


def compare(spark, query, sql):
    base = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        base.sql(f"create view {path.stem} as select * from '{path}'")
    wanted = base.sql(sql)
    names, want = rows_of(list(wanted.columns), wanted.fetchall())
    found = query(spark, SF)
    columns, got = rows_of(found.columns, [tuple(r) for r in found.collect()])
    assert columns == names
    assert got == want
