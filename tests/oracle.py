"""Side-by-side check of a query and its SQL counterpart."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _sorted_rows(table):
    names = sorted(table.column_names)
    columns = [table[n].to_pylist() for n in names]
    return names, sorted(tuple(_plain(v) for v in row) for row in zip(*columns))


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when names, types, row count and every value agree."""
    ours = spark_df.toArrow()
    theirs = con.execute(sql).to_arrow_table()
    problems = []
    types = lambda t: {f.name: str(f.type).replace("large_", "") for f in t.schema}
    if types(ours) != types(theirs):
        problems.append(f"types {types(ours)} != {types(theirs)}")
    a_names, a = _sorted_rows(ours)
    b_names, b = _sorted_rows(theirs)
    if a_names != b_names:
        return [*problems, f"columns {a_names} != {b_names}"]
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    unlike = [(x, y) for x, y in zip(a, b) if x != y]
    if unlike:
        problems.append(f"{len(unlike)} rows differ, first {unlike[0]}")
    return problems
