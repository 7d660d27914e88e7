"""Runs a registered query and its DuckDB counterpart and compares every value exactly."""

import glob
import os

import duckdb

from __spark_entry__ import oracle_sql, queries


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(rows, columns, names):
    order = [columns.index(name) for name in names]
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark, con, sf_dir, name):
    """An empty list when columns, types and all rows agree."""
    df = queries()[name](spark, sf_dir)
    relation = con.sql(oracle_sql()[name])
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} != {sorted(relation.columns)}"]
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    wanted = {
        "string": "VARCHAR",
        "int": "INTEGER",
        "bigint": "BIGINT",
        "double": "DOUBLE",
        "boolean": "BOOLEAN",
        "date": "DATE",
    }
    found = [
        f"type of {c}: {kind} != {kinds[c]}" for c, kind in df.dtypes if wanted.get(kind) != kinds[c]
    ]
    mine = _sorted(df.collect(), df.columns, names)
    theirs = _sorted(relation.fetchall(), list(relation.columns), names)
    if len(mine) != len(theirs):
        found.append(f"{len(mine)} rows != {len(theirs)}")
    unequal = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if unequal:
        found.append(f"{len(unequal)} of {len(mine)} rows differ, e.g. {unequal[0]}")
    return found
