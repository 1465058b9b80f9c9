"""Every query with SQL gives the rows of its SQL at the smallest scale."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")


def rows(df):
    cols = sorted(df.columns)
    return sorted(repr([x.item() if hasattr(x, "item") else x for x in r]) for r in df[cols].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def names():
    from edispark.catalogue import QUERIES

    return list(QUERIES)


@pytest.mark.parametrize("name", names())
def test_query(spark, duck, name):
    from edispark.catalogue import ORACLE_SQL, QUERIES

    got = QUERIES[name](spark, SF).toPandas()
    want = duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_truncated_files_are_composed_in_turns_without_a_whole_copy(spark, monkeypatch):
    from pyspark.sql import functions as F

    from edispark import catalogue
    from edispark.operators import read

    made = []
    own = catalogue.shared_dir
    monkeypatch.setattr(catalogue, "_MADE", {})
    monkeypatch.setattr(catalogue, "shared_dir", lambda spark, name: made.append((name, own(spark, name))) or made[-1][1])
    assert catalogue.lenient_truncated(spark, SF).count() == 2
    assert [name for name, _ in made] == ["truncated"] * catalogue.TURNS
    numbers = [{r[0] for r in read.read_raw(spark, path, lenient=True).where("record_type = 'C'").select(F.substring(F.col("raw_record").cast("string"), 14, 16)).collect()} for _, path in made]
    assert all(numbers) and sum(map(len, numbers)) == len(set().union(*numbers)) == spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey").distinct().count()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
