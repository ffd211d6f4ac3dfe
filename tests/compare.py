"""Run a registered query and its SQL twin and compare them as unordered tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb

SPARK_TO_DUCK = {
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "date": {"DATE"},
    "boolean": {"BOOLEAN"},
    "timestamp": {"TIMESTAMP"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        if math.isnan(a) or math.isnan(b):
            return math.isnan(a) and math.isnan(b)
        return repr(a) == repr(b)
    return a == b


def compare(spark_df, con, sql: str) -> list[str]:
    """Problems found; empty means equal."""
    cursor = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in cursor.description}
    duck_rows = cursor.fetchall()
    spark_types = dict(spark_df.dtypes)
    problems = []
    if set(duck_types) != set(spark_types):
        return [f"columns {sorted(spark_types)} vs {sorted(duck_types)}"]
    for name, kind in spark_types.items():
        if duck_types[name] not in SPARK_TO_DUCK.get(kind, {duck_types[name]}):
            problems.append(f"type of {name}: {kind} vs {duck_types[name]}")
    names = sorted(spark_types)
    order = [list(duck_types).index(n) for n in names]
    left = sorted([tuple(r[n] for n in names) for r in spark_df.collect()], key=_key)
    right = sorted([tuple(r[i] for i in order) for r in duck_rows], key=_key)
    if len(left) != len(right):
        return [*problems, f"rows {len(left)} vs {len(right)}"]
    if not left:
        problems.append("no rows")
    wrong = [(a, b) for a, b in zip(left, right) if not all(map(_same, a, b))]
    if wrong:
        problems.append(f"{len(wrong)} of {len(left)} rows differ; columns {names}; first {wrong[0]}")
    return problems
