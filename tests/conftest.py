import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(TESTDATA):
        pytest.skip("test tables are not here")
    return TESTDATA


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    db = duckdb.connect()
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        db.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return db


@pytest.fixture(scope="session")
def same():
    """Compares a frame with DuckDB's rows, whatever their order."""
    from collections import Counter

    def compare(df, relation):
        columns, names = sorted(df.columns), list(relation.columns)
        assert columns == sorted(names)
        at = [names.index(c) for c in columns]
        got = Counter(tuple(r[c] for c in columns) for r in df.collect())
        want = Counter(tuple(r[i] for i in at) for r in relation.fetchall())
        assert got == want

    return compare
