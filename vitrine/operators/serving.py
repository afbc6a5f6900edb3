"""Keyed, versioned serving tables as an append-only changelog plus views
(K8, K9, W2, S8).

A put appends ``(row_key, put_seq, cells...)``.  Views:

* latest per key: ``max_by(struct, put_seq)`` — a partial aggregate, so a
  key written a billion times still ships one row per map task;
* last N versions: ``row_number() <= N`` over ``put_seq desc``; Spark plans
  a WindowGroupLimit under the exchange, i.e. a map-side top-N per key.

Puts of one key with equal ``put_seq`` are ordered by their cells, so both views
are the same under any order of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine import constants as C


def latest_by_key(changelog: DataFrame, key: str = "row_key", seq: str = "put_seq") -> DataFrame:
    cells = [c for c in changelog.columns if c not in (key,)]
    latest = F.max_by(F.struct(*cells), F.struct(seq, *cells)).alias("_v")
    return changelog.groupBy(key).agg(latest).select(key, *[F.col(f"_v.{c}").alias(c) for c in cells])


def versions_by_key(changelog: DataFrame, n: int, key: str = "row_key", seq: str = "put_seq") -> DataFrame:
    cells = [F.col(c).desc() for c in changelog.columns if c not in (key, seq)]
    w = Window.partitionBy(key).orderBy(F.col(seq).desc(), *cells)
    return changelog.withColumn("version", F.row_number().over(w)).where(F.col("version") <= n)


def metric_puts(windows: DataFrame) -> DataFrame:
    """One metric put per emitted (window, product): closed windows under
    ``category#product``, flushed ones under ``FINAL#product``."""
    return windows.select("row_key", F.col("clicks").alias("clicks_window"),
                          F.col("window_end").alias("last_window_end"),
                          F.col("window_end").alias("put_seq"))


def metrics_latest(puts: DataFrame) -> DataFrame:
    return latest_by_key(puts).drop("put_seq")


def metrics_versions(puts: DataFrame, n: int = C.METRIC_VERSIONS) -> DataFrame:
    return versions_by_key(puts, n).drop("put_seq")


def alerts_latest(alert_puts: DataFrame) -> DataFrame:
    return latest_by_key(alert_puts).drop("put_seq")


def alerts_versions(alert_puts: DataFrame, n: int = C.ALERT_VERSIONS) -> DataFrame:
    return versions_by_key(alert_puts, n).drop("put_seq")


def lookup(latest: DataFrame, key_value: str, key: str = "row_key") -> DataFrame:
    """Point read by row key on a latest view."""
    return latest.where(F.col(key) == key_value)


def compact(spark, changelog_path: str, out_path: str, n: int, key: str = "row_key",
            seq: str = "put_seq") -> None:
    """Rewrite a changelog keeping the last ``n`` versions per key (the
    ordinary batch job that bounds the append-only table)."""
    log = spark.read.parquet(changelog_path)
    versions_by_key(log, n, key, seq).drop("version").write.mode("overwrite").parquet(out_path)
