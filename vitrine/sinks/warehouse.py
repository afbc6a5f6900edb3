"""Warehouse sinks and reads.

Tables are ``USING orc PARTITIONED BY (dt)`` in Spark's catalog (a table
created ``STORED AS ORC`` is a Hive-format table and refuses a DataFrame
``format("orc")`` write).  Writes replace only the partitions present in the
data (dynamic partition overwrite), so re-running a date is idempotent;
``append`` is kept as an explicit mode for parity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.schemas import DW_COLUMNS, DW_DDL


class Warehouse:
    def __init__(self, spark: SparkSession, database: str, location: str):
        self.spark = spark
        self.database = database
        self.location = location.rstrip("/")

    def create(self) -> Warehouse:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.location}'")
        for table, ddl in DW_DDL.items():
            self.spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.database}.{table} ({ddl})
                               USING orc PARTITIONED BY (dt)
                               LOCATION '{self.location}/{table}'""")
        return self

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def write(self, table: str, df: DataFrame, mode: str = "overwrite") -> None:
        """``overwrite``: dynamic partition overwrite (default, idempotent);
        ``append``: add rows (re-running a date duplicates it)."""
        ordered = df.select(*DW_COLUMNS[table], "dt")  # insertInto is positional
        writer = ordered.write
        if mode == "overwrite":
            key = "spark.sql.sources.partitionOverwriteMode"
            before = self.spark.conf.get(key)
            self.spark.conf.set(key, "dynamic")      # insertInto reads the session setting
            try:
                writer.insertInto(self.name(table), overwrite=True)
            finally:
                self.spark.conf.set(key, before)
        elif mode == "append":
            writer.insertInto(self.name(table), overwrite=False)
        else:
            raise ValueError(f"unknown mode {mode}")

    def drop_dates(self, table: str, dates: list[str]) -> None:
        """Removes the partitions of dates that have no rows any more."""
        for dt in dates:
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION (dt = '{dt}')")

    def read(self, table: str, dt: str | None = None) -> DataFrame:
        """Table scan; a ``dt`` value becomes a partition filter."""
        df = self.spark.table(self.name(table))
        return df if dt is None else df.where(F.col("dt") == dt)


def _dw_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(DW_DDL[table])


def write_partitioned_path(df: DataFrame, table: str, path: str) -> None:
    """Catalog-less sink (K7): Parquet at ``path/dt=<date>``; only the
    partitions in ``df`` are replaced."""
    (df.select(*DW_COLUMNS[table], "dt").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path))


def read_partitioned_path(spark: SparkSession, table: str, path: str, dt: str | None = None) -> DataFrame:
    """Reads ``dt`` as the declared STRING (no partition type inference)."""
    df = spark.read.schema(_dw_schema(table)).parquet(path)
    return df if dt is None else df.where(F.col("dt") == dt)
