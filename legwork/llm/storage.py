"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from legwork.session import work_dir


def landed(rows: DataFrame) -> DataFrame:
    """The rows written as Parquet under ``spark.checkpoint.dir`` and read again.

    Later steps read the table instead of computing the rows anew, also after an
    executor is lost.
    """
    folder = f"{work_dir(rows.sparkSession)}/rows"
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def free_name(rows: DataFrame, name: str) -> str:
    """The name, made longer until no column has it."""
    while name in rows.columns:
        name += "_"
    return name
