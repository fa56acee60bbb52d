"""Run a query and its SQL, and compare the rows regardless of order."""

from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from workload.oracle import ORACLE
from workload.queries import QUERIES


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple(None if v is None or v is pd.NaT or v != v else v for v in row)
        for row in frame.astype(object).itertuples(index=False, name=None)
    ]
    return sorted(rows, key=repr)


def expected(name: str, sf_dir: str) -> pd.DataFrame:
    with duckdb.connect() as con:
        for file in Path(sf_dir).glob("*.parquet"):
            con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        names = [c[0] for c in con.execute(ORACLE[name]).description]
        return pd.DataFrame(con.execute(ORACLE[name]).fetchall(), columns=names, dtype=object)


def actual(spark: SparkSession, name: str, sf_dir: str) -> pd.DataFrame:
    df = QUERIES[name](spark, sf_dir)
    return pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)


def differences(spark: SparkSession, name: str, sf_dir: str) -> str:
    """Empty if the results are equal, else what differs first."""
    got, want = actual(spark, name, sf_dir), expected(name, sf_dir)
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    mine, theirs = _rows(got), _rows(want)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} of {len(mine)} rows, first {wrong[0]}" if wrong else ""
