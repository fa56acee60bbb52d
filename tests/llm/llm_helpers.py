"""Small corpora for the training-data operators."""

from pathlib import Path

import duckdb
import pandas as pd

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
SF = "/root/testdata/sf0.001"


def docs(spark, *texts, first=0):
    rows = [(first + i, t, "en", "src", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def sf_texts(sf_dir=SF):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY 1").fetchall()


def same_as_sql(df, sql, sf_dir):
    """Whether the rows equal those of the SQL over the tables of a folder."""
    with duckdb.connect() as con:
        for file in Path(sf_dir).glob("*.parquet"):
            con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        names = [c[0] for c in con.execute(sql).description]
        want = sorted(tuple(r) for r in con.execute(f"SELECT {', '.join(sorted(names))} FROM ({sql})").fetchall())
    got = sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())
    return sorted(names) == sorted(df.columns) and got == want


def frame(df) -> pd.DataFrame:
    return pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns)
