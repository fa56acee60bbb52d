import pytest
from llm_helpers import SF, docs, same_as_sql
from pyspark.sql import functions as F

from sowcast.llm import exact_dedup, queries


def groups(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in df.collect()}


def test_same_as_sql(spark):
    got = queries.op10_exact_dedup(spark, SF)
    assert same_as_sql(got, queries.ORACLE["op10_exact_dedup"], SF)


@pytest.mark.parametrize("digest", [F.md5, F.length, lambda t: F.lit("x")])
def test_white_space_nulls_and_colliding_digests(spark, digest):
    table = docs(spark, "a b", "a\t\n b", "ab", None, "", " ", "  ", "A b", "x" * 300_000, "x" * 300_000)
    assert groups(exact_dedup.copy_groups(table, digest=digest)) == {
        0: (0, 2, True),
        1: (0, 2, False),
        2: (2, 1, True),
        3: (3, 2, True),
        4: (3, 2, False),
        5: (5, 2, True),
        6: (5, 2, False),
        7: (7, 1, True),
        8: (8, 2, True),
        9: (8, 2, False),
    }


def test_only_ascii_space_is_space(spark):
    table = docs(spark, "a b", "a b", "a\u0085b", "a\x1cb", "a\x0b\x0cb")
    assert [g[0] for _, g in sorted(groups(exact_dedup.copy_groups(table)).items())] == [0, 1, 2, 3, 0]


def test_ids_that_are_missing_or_repeat_and_clashing_columns(spark):
    rows = [(None, "a", 1), (5, "a", 2), (5, "a", 2), (3, "b", 3), (None, "c", 4), (None, "c", 5), (5, "d", 6)]
    table = spark.createDataFrame(rows, "doc_id LONG, text STRING, digest LONG")
    marked = exact_dedup.copy_groups(table).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in marked) == [
        ("3", "3", 1, True),
        ("5", "5", 1, True),
        ("5", "5", 3, True),
        ("5", "5", 3, True),
        ("None", "5", 3, False),
        ("None", "None", 2, True),
        ("None", "None", 2, True),
    ]
    left = exact_dedup.without_copies(table)
    assert left.columns == table.columns
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == [
        ("3", "b"),
        ("5", "a"),
        ("5", "d"),
        ("None", "c"),
    ]


def test_empty_table(spark):
    assert exact_dedup.copy_groups(docs(spark, "a").limit(0)).count() == 0
    assert exact_dedup.without_copies(docs(spark, "a").limit(0)).count() == 0
