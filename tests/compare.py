"""Compare a Spark result with DuckDB: names, types in broad classes, and values regardless of row order."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


_CLASSES = {
    "bigint": "int64",
    "int": "int32",
    "double": "double",
    "float": "float",
    "string": "text",
    "boolean": "bool",
    "date": "date",
    "timestamp_ntz": "timestamp",
    "timestamp": "timestamp",
    "BIGINT": "int64",
    "INTEGER": "int32",
    "DOUBLE": "double",
    "FLOAT": "float",
    "VARCHAR": "text",
    "BOOLEAN": "bool",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
}


def spark_result(df):
    names = sorted(df.columns)
    types = dict(df.dtypes)
    rows = [tuple(row[name] for name in names) for row in df.collect()]
    return [(n, _CLASSES.get(types[n], types[n])) for n in names], rows


def duck_result(con, sql):
    relation = con.sql(sql)
    columns, types = list(relation.columns), [str(t) for t in relation.types]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(row[i] for i in order) for row in relation.fetchall()]
    return [(columns[i], _CLASSES.get(types[i], types[i])) for i in order], rows


def canonical(rows):
    return sorted(tuple("<null>" if v is None else repr(v) for v in row) for row in rows)


def assert_same(df, con, sql):
    spark_schema, spark_rows = spark_result(df)
    duck_schema, duck_rows = duck_result(con, sql)
    assert spark_schema == duck_schema
    assert len(spark_rows) == len(duck_rows)
    left, right = canonical(spark_rows), canonical(duck_rows)
    differing = [(a, b) for a, b in zip(left, right) if a != b]
    assert not differing, f"{len(differing)} rows differ, first: {differing[0]}"
    return len(left)
