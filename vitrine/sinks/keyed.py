"""Stored keyed tables (K8, K9, W2, S8, O1): puts by row key, the last N versions of each.

Two levels.  A put batch is a *delta*: a Parquet folder, rewritten whole if the batch is replayed.
``merge`` folds the deltas into the *base*, a Spark table that is partitioned by a part of the
key and bucketed and sorted by ``row_key``; only the partitions that the deltas touch
are rewritten, and at most N versions of a key stay.

A point read names its partition, its bucket (Spark prunes both) and, files being sorted,
few row groups.  Keys that begin with a reversed time are partitioned by their prefix and
its leading digits, so the newest keys of a prefix are in its first partitions, and
nothing older is opened.

Every stored row carries its batch.  Base rows of a batch that still has a delta are
left out of reads and merges, so a merge that failed half-way, or before it removed its deltas, is simply run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators.serving import latest_by_key, versions_by_key
from vitrine.streaming.files import child_names, delete, exists

#: Leading digits of a 13-digit reversed time in milliseconds: 10^9 ms, 11.6 days, a partition.
TIME_DIGITS = 4


def by_prefix_and_time(key: Column, digits: int = TIME_DIGITS) -> Column:
    """Partition of keys ``PREFIX#<reversed time>#...``: newest first within a prefix."""
    return F.concat(F.substring_index(key, "#", 1), F.lit("#"), F.substring(F.split_part(key, F.lit("#"), F.lit(2)), 1, digits))


def undivided(key: Column) -> Column:
    """One partition, for keys without a time; buckets divide it."""
    return F.lit("all")


class KeyedTable:
    def __init__(self, spark: SparkSession, database: str, name: str, location: str, cells: str, versions: int,
                 part: Callable[[Column], Column] = undivided, buckets: int = 8):
        """``cells``: DDL of the columns besides ``row_key`` and ``put_seq``."""
        self.spark, self.table, self.location = spark, f"{database}.{name}", location.rstrip("/")
        self.cells, self.versions, self.part, self.buckets = cells, versions, part, buckets
        self.columns = ["row_key", *[c.strip().split()[0] for c in cells.split(",")], "put_seq"]

    def create(self) -> KeyedTable:
        """The table in the catalog; one whose files exist already is found again."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.table.split('.')[0]}")
        self.spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.table} (row_key STRING, {self.cells}, put_seq BIGINT, put_batch BIGINT, part STRING)
                           USING parquet PARTITIONED BY (part) CLUSTERED BY (row_key) SORTED BY (row_key) INTO {self.buckets} BUCKETS
                           LOCATION '{self.location}/base'""")
        if exists(self.spark, f"{self.location}/base"):
            self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
        return self

    # ------------------------------------------------------------ puts
    def put(self, puts: DataFrame, batch_id: int) -> None:
        """One batch of puts; the same batch again replaces it."""
        (puts.select(*self.columns, self.part(F.col("row_key")).alias("part")).sortWithinPartitions("part", "row_key")
         .write.mode("overwrite").partitionBy("part").parquet(f"{self.location}/delta/put_batch={batch_id}"))

    def deltas(self) -> list[int]:
        names = child_names(self.spark, f"{self.location}/delta")
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("put_batch="))

    def merge(self) -> None:
        """Deltas into the base; afterwards there are none."""
        ids = self.deltas()
        if not ids:
            return
        touched = [r.part for r in self._delta(ids).select("part").distinct().collect()]
        rows = self._base(ids).where(F.col("part").isin(touched)).unionByName(self._delta(ids))
        order = rows.drop("put_batch").columns
        kept = versions_by_key(rows.select(*order, "put_batch"), self.versions).drop("version")
        kept = kept.select(*self.columns, "put_batch", "part").repartition("part", F.pmod(F.hash("row_key"), F.lit(self.buckets)))
        if touched:
            key = "spark.sql.sources.partitionOverwriteMode"
            before = self.spark.conf.get(key)
            self.spark.conf.set(key, "dynamic")
            try:
                # (a table cannot be overwritten while it is read: the new rows are written aside first)
                aside = f"{self.location}/merging"
                kept.write.mode("overwrite").parquet(aside)
                again = self.spark.read.schema(kept.schema).parquet(aside)
                again.repartition("part", F.pmod(F.hash("row_key"), F.lit(self.buckets))).write.insertInto(self.table, overwrite=True)
            finally:
                self.spark.conf.set(key, before)
            delete(self.spark, aside)
        for i in ids:
            delete(self.spark, f"{self.location}/delta/put_batch={i}")

    # ------------------------------------------------------------ reads
    def _schema(self) -> str:
        return f"row_key string, {self.cells}, put_seq bigint, put_batch bigint, part string"

    def _base(self, pending: list[int]) -> DataFrame:
        base = self.spark.table(self.table)
        return base.where(~F.col("put_batch").isin(pending)) if pending else base

    def _delta(self, ids: list[int]) -> DataFrame:
        paths = [f"{self.location}/delta/put_batch={i}" for i in ids]
        return self.spark.read.schema(self._schema()).option("basePath", f"{self.location}/delta").parquet(*paths)

    def rows(self, where: Column | None = None) -> DataFrame:
        """Stored puts; the condition is applied to each level, where it prunes."""
        pending = self.deltas()
        levels = [self._base(pending)] + ([self._delta(pending)] if pending else [])
        out = None
        for level in levels:
            level = (level if where is None else level.where(where)).select(*self.columns)
            out = level if out is None else out.unionByName(level)
        return out

    def get(self, key: str) -> DataFrame:
        """The latest cells of one key."""
        return latest_by_key(self.rows((F.col("part") == self.part(F.lit(key))) & (F.col("row_key") == key)))

    def versions_of(self, key: str) -> DataFrame:
        return versions_by_key(self.rows((F.col("part") == self.part(F.lit(key))) & (F.col("row_key") == key)), self.versions)

    def latest(self) -> DataFrame:
        return latest_by_key(self.rows())

    def parts(self, prefix: str) -> list[str]:
        """Partitions of keys with this prefix, newest first (names only: nothing is opened)."""
        found = [r.partition for r in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()]
        for i in self.deltas():
            found += [n for n in child_names(self.spark, f"{self.location}/delta/put_batch={i}") if n.startswith("part=")]
        from urllib.parse import unquote
        return sorted({p for p in (unquote(f.split("=", 1)[1]) for f in found) if p.startswith(prefix + "#")})

    def newest(self, prefix: str, n: int) -> DataFrame:
        """The first n keys of a prefix with their latest cells: as many of its first partitions are read as hold n keys."""
        parts, take = self.parts(prefix), 1
        while True:
            here = F.col("part").isin(parts[:take]) & F.col("row_key").startswith(prefix + "#")
            if take >= len(parts) or self.rows(here).select("row_key").distinct().limit(n).count() >= n:
                return latest_by_key(self.rows(here)).orderBy("row_key").limit(n)
            take *= 2
