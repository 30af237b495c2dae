"""Parquet tables: append, replace, keyed merges, and keyed batches.

A table that is replaced or merged is a set of parts, each a folder of its own, and a
published list of the parts that are current. New parts are written first and published
last, by one small file with the next number. So a reader sees the old rows or the new
ones, also after a crash, and rows read from a table may replace it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legwork.operators.merge import latest_by_key
from legwork.session import work_dir

PUBLISHED = "_published"
BUCKET, _FILE = "_bucket", "_file"
#: Rows of the first load per bucket of a merged table, and its fewest buckets.
BUCKET_ROWS, LEAST_BUCKETS = 4_000_000, 16
#: Rows of a merged table per file, about; a task sorts those of one at a time.
FILE_ROWS = 100_000
#: Whole documents take about a third less room than with Spark's default codec, and are written as fast.
CODEC = "zstd"


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("append").partitionBy(*(partition_by or [])).parquet(path, compression=CODEC)


def _folder(spark: SparkSession, path: str):
    """The file system of a path and a function that makes its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published lists, newest first."""
    fs, make = _folder(spark, path)
    folder = make(f"{path}/{PUBLISHED}")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted((int(name) for name in names if name.isdigit()), reverse=True)


def _latest(spark: SparkSession, path: str) -> int:
    return next(iter(_numbers(spark, path)), 0)


def _parts(spark: SparkSession, path: str, at: int | None = None) -> dict[str, str]:
    """Parts that are current, or were with number ``at``: bucket to folder; empty before the first publication.

    A list that cannot be read, as a store without atomic renames may leave it after a
    crash, was never current: the one before it is.
    """
    for number in [at] if at else _numbers(spark, path) if at is None else []:
        line = spark.read.text(f"{path}/{PUBLISHED}/{number:09d}", wholetext=True).first()
        try:
            return json.loads(line[0] if line else "")
        except ValueError:
            continue
    return {}


def _publish(spark: SparkSession, path: str, parts: dict[str, str], number: int) -> None:
    """Make the parts current. Fails if another writer has published that number.

    The list is written under another name and renamed, so it appears with its content.
    """
    fs, make = _folder(spark, path)
    fresh, final = make(f"{path}/{PUBLISHED}/_{uuid.uuid4().hex}"), make(f"{path}/{PUBLISHED}/{number:09d}")
    out = fs.create(fresh, False)
    try:
        out.write(bytearray(json.dumps(parts).encode()))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.makeQualified(final).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(final), spark._sc._gateway.new_array(hadoop.Options.Rename, 0))


def new_part() -> str:
    return f"data-{uuid.uuid4().hex}"


def publish_part(spark: SparkSession, path: str, part: str) -> None:
    """Make a part that is written the table's only one."""
    _publish(spark, path, {"": part}, _latest(spark, path) + 1)


def current_part(spark: SparkSession, path: str) -> str:
    """Folder of a table that is one part."""
    return f"{path}/{_parts(spark, path)['']}"


def replace(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Make the rows the table's only ones."""
    part = new_part()
    df.write.partitionBy(*(partition_by or [])).parquet(f"{path}/{part}", compression=CODEC)
    publish_part(df.sparkSession, path, part)


def merge_into(
    updates: DataFrame,
    path: str,
    keys: list[str],
    order: list[Column],
    buckets: int | None = None,
    bucket_by: list[str] | None = None,
    onto: int | None = None,
) -> int:
    """Update stored rows whose key exists and insert the others; the newest version wins.

    Rows lie in buckets by a hash of ``bucket_by``, the key unless given. Only buckets that
    the updates touch are read and written, about ``FILE_ROWS`` rows a file or more where a
    task takes several; all others keep their parts. The number of buckets is that of the first load, by its rows unless
    given. The updates are computed once and reduced to one row per key before they meet the
    stored rows; where no key comes twice, whole rows move once, to their file.
    They are merged into the rows as of number ``onto`` (0: none), the current ones unless
    given. Returns the number of the new rows.
    """
    spark, number = updates.sparkSession, _latest(updates.sparkSession, path) + 1
    parts = _parts(spark, path, onto)
    fresh = f"{work_dir(spark)}/updates"
    updates.write.parquet(fresh, compression=CODEC)
    fresh = spark.read.schema(updates.schema).parquet(fresh)
    found = fresh.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("most")).first()
    if (found["most"] or 0) > 1:
        fresh = latest_by_key(fresh, keys, order)
    buckets = int(parts.get("buckets", buckets or max(LEAST_BUCKETS, -(-found["rows"] // BUCKET_ROWS))))
    bucket = F.pmod(F.xxhash64(*(bucket_by or keys)), F.lit(buckets)).cast("int")
    placed = fresh.withColumn(BUCKET, bucket)
    touched = {str(row[0]) for row in placed.select(BUCKET).distinct().collect()}
    known = [f"{path}/{parts[bucket]}" for bucket in sorted(touched) if bucket in parts]
    stored = spark.read.parquet(*known).withColumn(BUCKET, bucket) if known else None
    rows = found["rows"] + (stored.count() if known else 0)
    files = max(1, -(-rows // (FILE_ROWS * max(1, len(touched)))))
    file = F.pmod(F.xxhash64(*keys, F.lit("file")), F.lit(files))
    if known:
        together = stored.unionByName(placed, allowMissingColumns=True).withColumn(_FILE, file)
        placed = latest_by_key(together.repartition(BUCKET, _FILE), [BUCKET, _FILE, *keys], order).drop(_FILE)
    else:
        placed = placed.repartition(BUCKET, file)
    part = new_part()
    placed.write.partitionBy(BUCKET).parquet(f"{path}/{part}", compression=CODEC)
    current = {**parts, **{bucket: f"{part}/{BUCKET}={bucket}" for bucket in touched}, "buckets": str(buckets)}
    _publish(spark, path, current, number)
    return number


def is_published(spark: SparkSession, path: str) -> bool:
    return bool(_parts(spark, path))


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, at: int | None = None) -> DataFrame:
    """The current rows, or those as of number ``at``."""
    parts = {bucket: part for bucket, part in _parts(spark, path, at).items() if bucket != "buckets"}
    table = spark.read.parquet(*[f"{path}/{part}" for part in parts.values()] if parts else [path])
    return table.select(*columns) if columns else table


#: Folder of compacted rows; batches of a stream are numbered from 0.
BASE_BATCH = -1


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of changes into its own folder.

    A batch that is run again overwrites only itself, so a replay changes nothing.
    """
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}", compression=CODEC)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def compact(rows: DataFrame, path: str) -> None:
    """Write current rows into a folder that no batch of a stream can overwrite."""
    write_batch(rows, path, BASE_BATCH)
