"""Tables of a SQLite taxonomy database, read in rowid ranges."""

from __future__ import annotations

import sqlite3
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

RANGE_ROWS = 100_000

# Storage classes by a part of the declared type.
_KINDS = (("INT", LongType()), ("REAL", DoubleType()), ("FLOA", DoubleType()), ("DOUB", DoubleType()))


@dataclass
class RowRange(InputPartition):
    low: int
    high: int


def _connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class SqliteReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path, self.table = options["path"], options["table"]
        self.step = int(options.get("rangerows", RANGE_ROWS))
        self.columns = [f.name for f in schema.fields]

    def partitions(self):
        con = _connect(self.path)
        low, high = con.execute(
            f"select min(rowid), max(rowid) from {_quoted(self.table)}"
        ).fetchone()
        con.close()
        if low is None:
            return [RowRange(0, 0)]
        return [RowRange(x, min(x + self.step, high + 1)) for x in range(low, high + 1, self.step)]

    def read(self, partition):
        con = _connect(self.path)
        names = ", ".join(_quoted(c) for c in self.columns)
        rows = con.execute(
            f"select {names} from {_quoted(self.table)} where rowid >= ? and rowid < ?",
            (partition.low, partition.high),
        )
        yield from rows
        con.close()


class SqliteSource(DataSource):
    """A table of a SQLite file on a disk all executors share."""

    @classmethod
    def name(cls):
        return "sqlite"

    def schema(self):
        con = _connect(self.options["path"])
        info = con.execute(f"pragma table_info({_quoted(self.options['table'])})").fetchall()
        con.close()
        if not info:
            raise ValueError(f"no table {self.options['table']} in {self.options['path']}")
        fields = []
        for _, name, declared, *_rest in info:
            kind = next((k for mark, k in _KINDS if mark in declared.upper()), StringType())
            fields.append(StructField(name, kind))
        return StructType(fields)

    def reader(self, schema):
        return SqliteReader(self.options, schema)


def read_taxonomy(
    spark: SparkSession, db: str, table: str, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """A table (genomes, nodes, rank, tree) of the taxonomy database."""
    spark.dataSource.register(SqliteSource)
    return (
        spark.read.format("sqlite").option("table", table).option("rangerows", range_rows).load(db)
    )
