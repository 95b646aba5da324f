"""Status gate and all-or-nothing groups.

The reference loses a whole source when one of its rows fails. Here a failing row carries a
``fatal`` reason; the default sends only those rows to a quarantine table, parity mode drops
every group that holds one. Groups are removed with a null-safe left-anti join against the fatal
rows' keys; nothing aggregates between exchange and join, so AQE can split a skewed group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def status_gate(pages: DataFrame, status: str = "status") -> DataFrame:
    """Only HTTP 200 goes on; a missing status counts as 200."""
    if status not in pages.columns:
        return pages
    return pages.where(F.coalesce(F.col(status), F.lit(200)) == 200)


def http_failure(pages: DataFrame, status: str = "status") -> DataFrame:
    """Pages with a ``fatal`` reason where their status is not 200 (a missing status counts as 200)."""
    code = F.coalesce(F.col(status), F.lit(200)) if status in pages.columns else F.lit(200)
    return pages.withColumn("fatal", F.when(code != 200, F.concat(F.lit("HTTP "), code.cast("string"))))


def failing_groups(df: DataFrame, group: list[str], fatal: str = "fatal") -> DataFrame:
    """Keys of the fatal rows (a key may repeat)."""
    return df.where(F.col(fatal).isNotNull()).select(*group)


def drop_failed_groups(df: DataFrame, group: list[str], fatal: str = "fatal", failures: DataFrame | None = None) -> DataFrame:
    """Parity mode: a group with any fatal row contributes nothing; a null group is a group.

    ``failures`` adds fatal rows from elsewhere (failed pages, which yield no row of ``df``)."""
    bad = failing_groups(df, group, fatal)
    if failures is not None:
        bad = bad.unionByName(failing_groups(failures, group, fatal))
    bad = bad.toDF(*[f"_bad_{g}" for g in group])
    same = F.lit(True)
    for g in group:
        same = same & df[g].eqNullSafe(bad[f"_bad_{g}"])
    return df.join(bad, same, "left_anti")


def quarantine(df: DataFrame, fatal: str = "fatal") -> tuple[DataFrame, DataFrame]:
    """Default mode: (good rows, fatal rows with their reason)."""
    return df.where(F.col(fatal).isNull()), df.where(F.col(fatal).isNotNull())


def apply_error_policy(df: DataFrame, group: list[str], parity: bool, fatal: str = "fatal",
                       failures: DataFrame | None = None) -> DataFrame:
    return drop_failed_groups(df, group, fatal, failures) if parity else quarantine(df, fatal)[0]
