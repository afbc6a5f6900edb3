"""Small helpers over the Hadoop FileSystem of a path (any scheme the cluster
supports: hdfs://, s3a://, file:/).  Metadata only; data never passes
through the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def _rename(spark: SparkSession, staging: str, final_path: str) -> bool:
    fs, dst = _fs_path(spark, final_path)
    fs.mkdirs(dst.getParent())
    _, src = _fs_path(spark, staging)
    if not fs.rename(src, dst):
        if exists(spark, final_path):       # a concurrent attempt published first
            return False
        raise IOError(f"could not publish {staging} as {final_path}")
    return True


def _staging(staging_root: str) -> str:
    import uuid
    return f"{staging_root.rstrip('/')}/{uuid.uuid4().hex}"


def publish(spark: SparkSession, df, final_path: str, staging_root: str, fmt: str = "parquet") -> bool:
    """Write ``df`` aside, then rename it to ``final_path`` in one metadata
    step, so readers (a downstream file stream) see a batch entirely or not at
    all.  A path that exists is complete and is never rewritten: returns False.
    """
    if exists(spark, final_path):
        return False
    staging = _staging(staging_root)
    df.write.mode("overwrite").format(fmt).save(staging)
    return _rename(spark, staging, final_path)


def publish_parts(spark: SparkSession, df, column: str, final_paths: dict[str, str], staging_root: str) -> bool:
    """As ``publish``, with one write for several paths: rows go by the value of ``column``.

    Values without rows get no folder, but for the first, whose folder tells that the write is complete: it comes last.
    """
    first = next(iter(final_paths.values()))
    if exists(spark, first):
        return False
    staging = _staging(staging_root)
    df.write.mode("overwrite").partitionBy(column).parquet(staging)
    for value, final_path in reversed(final_paths.items()):
        part = f"{staging}/{column}={value}"
        if exists(spark, part):
            if not exists(spark, final_path):
                _rename(spark, part, final_path)
        elif final_path == first:
            fs, p = _fs_path(spark, final_path)
            fs.mkdirs(p)
    return True


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (metadata listing)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]
