"""Documents and their three tables, each landed once per session and folder.

The queries read these parquet tables, as they would on a cluster where the
ingest has run before; a table is landed when a query first reads it. The folder
lies under the shared work folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from legwork.operators.normalize import delays, flights, legs
from legwork.plans import raw
from legwork.session import work_dir
from legwork.sources.tables import read_table, replace
from suite import fixture

TABLES = {"flights": flights, "legs": legs, "delays": delays}

_folders: dict[tuple[str, str], str] = {}
_landed: set[str] = set()


def _folder(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _folders:
        _folders[key] = work_dir(spark)
    return _folders[key]


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``documents``, ``flights``, ``legs`` or ``delays`` as landed."""
    if name == "documents":
        return read_table(spark, landed_at(spark, sf_dir, name, lambda path: _write_documents(spark, sf_dir, path)))
    return landed_mart(spark, sf_dir, name, lambda: TABLES[name](staged(spark, sf_dir, "documents")))


def _write_documents(spark: SparkSession, sf_dir: str, path: str) -> None:
    key, value = fixture.SORTED
    before = spark.conf.get(key, "false")
    spark.conf.set(key, value)
    try:
        replace(fixture.documents(spark, sf_dir), path)
    finally:
        spark.conf.set(key, before)


def raw_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        raw.raw_flights(staged(spark, sf_dir, "flights")),
        raw.raw_legs(staged(spark, sf_dir, "legs")),
        raw.raw_delays(staged(spark, sf_dir, "delays")),
    )


def landed_at(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The folder that ``write`` fills on its first use."""
    folder = f"{_folder(spark, sf_dir)}/{name}"
    if folder not in _landed:
        write(folder)
        _landed.add(folder)
    return folder


def landed_mart(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A mart table, built and written on its first use."""
    return read_table(spark, landed_at(spark, sf_dir, name, lambda path: replace(build(), path)))
