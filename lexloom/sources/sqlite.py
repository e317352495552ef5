"""SQLite tables as a Spark data source: ``format("sqlite_table")``, options ``path`` and ``table``.

A database is one file, so one task reads it (from a path that executors see)
and the driver writes it; Parquet is the native sink.
"""

from __future__ import annotations

import os
import re
import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader
from pyspark.sql.types import BooleanType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructType

_NAME = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def _named(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a table or column name: {name!r}")
    return name


class _Reader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.path, self.table, self.columns = options["path"], _named(options["table"]), [_named(f.name) for f in schema.fields]

    def read(self, partition) -> Iterator[tuple]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            yield from db.execute(f"SELECT {', '.join(self.columns)} FROM {self.table}")


class SqliteTable(DataSource):
    @classmethod
    def name(cls):
        return "sqlite_table"

    def schema(self):
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            rows = db.execute(f"PRAGMA table_info({_named(self.options['table'])})").fetchall()
        kinds = {"INTEGER": "bigint", "INT": "bigint", "REAL": "double"}
        return ", ".join(f"{r[1]} {kinds.get(r[2].upper(), 'string')}" for r in rows)

    def reader(self, schema):
        return _Reader(self.options, schema)


def _kind(kind) -> str:
    if isinstance(kind, (LongType, IntegerType, ShortType, BooleanType)):
        return "INTEGER"
    return "REAL" if isinstance(kind, (DoubleType, FloatType)) else "TEXT"


def write(df: DataFrame, path: str, table: str, order: str | None = None, index: str = "", constraints: dict[str, str] | None = None, primary: str = "") -> None:
    """Replace a table of the database, rows in the given order.

    Rows are sorted on the executors and come to the driver a partition at a
    time; only the driver opens the file.  ``constraints`` follow a column's
    type, ``index`` and ``primary`` list columns.
    """
    found = constraints or {}
    columns = [f"{_named(f.name)} {_kind(f.dataType)} {found.get(f.name, '')}".strip() for f in df.schema.fields]
    if primary:
        columns.append(f"PRIMARY KEY ({', '.join(_named(c.strip()) for c in primary.split(','))})")
    rows = (df.orderBy(order) if order else df).toLocalIterator()
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    db = sqlite3.connect(path, isolation_level=None)
    try:
        db.execute("BEGIN")
        db.execute(f"DROP TABLE IF EXISTS {_named(table)}")
        db.execute(f"CREATE TABLE {table} ({', '.join(columns)})")
        db.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(df.columns))})", map(tuple, rows))
        for c in index.split(","):
            if c:
                db.execute(f"CREATE INDEX idx_{table}_{_named(c)} ON {table}({c})")
        db.execute("COMMIT")
    finally:
        db.close()


def read(spark: SparkSession, path: str, table: str) -> DataFrame:
    spark.dataSource.register(SqliteTable)
    return spark.read.format("sqlite_table").option("path", path).option("table", table).load()


def tables(path: str) -> dict[str, int]:
    """Row counts of a database's own tables; a missing file has none."""
    if not os.path.exists(path):
        return {}
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        counts = db.execute("SELECT group_concat('SELECT ' || quote(name) || ', count(*) FROM \"' || name || '\"', ' UNION ALL ') FROM sqlite_schema WHERE type = 'table' AND name NOT GLOB 'sqlite*'").fetchone()[0]
        return dict(db.execute(counts)) if counts else {}
