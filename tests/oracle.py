"""Compare a Spark result with DuckDB over the same parquet files."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return f"{type(v).__name__}:{v}"

    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql):
    ours = comparable(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    theirs = comparable([d[0] for d in result.description], result.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    different = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    assert not different, (len(different), different[0])
    return len(ours[1])
