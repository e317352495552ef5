import pytest

from lexloom.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, duck, same):
    same(QUERIES[name](spark, sf_dir), duck.sql(ORACLES[name]))


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1


def test_ranked_file_with_sharp_s(spark, tmp_path, same):
    """Capitals of some letters don't lead back to them."""
    import duckdb

    rows = spark.createDataFrame([(1, "Erßie und"), (2, "straße"), (3, "ﬁne É"), (4, "Plain words"), (5, " ")], "item_id long, text string")
    rows.write.parquet(str(tmp_path / "benchmark.parquet"))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{tmp_path}/benchmark.parquet/*.parquet')")
    same(QUERIES["ranked_file_round_trip"](spark, str(tmp_path)), db.sql(ORACLES["ranked_file_round_trip"]))
