"""Run registered queries next to their SQL twins and compare all values.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from stayscope.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def oracle_connection(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _sorted_rows(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "float": "FLOAT",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def differences(spark, con, folder: str, name: str) -> str:
    """Empty when both engines give the same columns, types and rows."""
    df = QUERIES[name](spark, folder)
    mine = _sorted_rows(df.columns, df.collect())
    if name not in ORACLES:
        return "" if mine else "no rows"
    cursor = con.execute(ORACLES[name])
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    theirs = _sorted_rows(list(kinds), cursor.fetchall())
    wanted = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if wanted != kinds:
        return f"schema {sorted(wanted.items())} and {sorted(kinds.items())}"
    if mine != theirs:
        apart = [(a, b) for a, b in zip(mine, theirs) if a != b][:2]
        return f"{len(mine)} and {len(theirs)} rows, first apart: {str(apart)[:600]}"
    return ""


def main(folder: str, names: list[str]) -> int:
    spark = build_session(
        "checks", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g", spark__driver__bindAddress="127.0.0.1", spark__driver__host="127.0.0.1",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(folder)
    bad = 0
    for name in names or QUERIES:
        began = time.time()
        try:
            found = differences(spark, con, folder, name)
        except Exception as error:  # report and go on to the next query
            found = f"{type(error).__name__}: {str(error)[:900]}"
        bad += bool(found)
        verdict = found or ("same" if name in ORACLES else "rows")
        print(f"{name:20} {time.time() - began:6.1f}s  {verdict}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
