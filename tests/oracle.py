"""Side-by-side comparison of a Spark result and DuckDB SQL on the same tables."""

import decimal
import math

import duckdb

from attestry.sources.adapters import TABLES


def connect(folder):
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, (int, float)):
        return (2, "nan" if isinstance(value, float) and math.isnan(value) else f"{value:.9g}")
    return (3, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(row[i]) for i in order) for row in rows])


def compare(df, db, sql):
    """Problems found, or an empty list."""
    result = db.execute(sql)
    theirs_columns = [c[0] for c in result.description]
    theirs = rows_of(theirs_columns, result.fetchall())
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if sorted(df.columns) != sorted(theirs_columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(theirs_columns)}")
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    if not problems and ours != theirs:
        mine, other = sorted(set(ours) - set(theirs)), sorted(set(theirs) - set(ours))
        problems.append(f"{len(mine)} differ; ours {mine[:2]} theirs {other[:2]}")
    if not ours:
        problems.append("no rows")
    return problems
