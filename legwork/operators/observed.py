"""Row counts taken while a job runs, without a second read of its rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows, and what counts them once an action has read them."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def write_counted(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Write the rows as Parquet and return how many there were."""
    rows, seen = observed(df, "written")
    rows.write.mode(mode).parquet(path)
    return seen.get["n"]


def guarded_join(
    before: DataFrame, join: Callable[[DataFrame], DataFrame], path: str, most_added: int | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """Write a join and count its rows before and after in the same job.

    ``join`` is given the rows to join. Returns the stored rows and ``before_rows``,
    ``after_rows`` and ``added_rows``; raises where more than ``most_added`` were added.
    """
    counted, seen_before = observed(before, "before")
    joined, seen_after = observed(join(counted), "after")
    joined.write.parquet(path)
    found = {"before_rows": seen_before.get["n"], "after_rows": seen_after.get["n"]}
    found["added_rows"] = found["after_rows"] - found["before_rows"]
    if most_added is not None and found["added_rows"] > most_added:
        raise ValueError(f"the join added {found['added_rows']} rows, more than {most_added}")
    return before.sparkSession.read.schema(joined.schema).parquet(path), found
