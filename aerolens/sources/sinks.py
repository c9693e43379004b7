"""Report sink.

Each report is written as the data behind its chart, one folder per report,
instead of a rendered image uploaded from the driver. Writes are distributed:
every task writes its own part files, and the job commit makes the folder
appear atomically, so a lost executor only reruns its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(
    df: DataFrame,
    base_path: str,
    name: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
) -> str:
    """Write ``df`` to ``<base_path>/report=<name>`` and return that path."""
    path = f"{base_path.rstrip('/')}/report={name}"
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_table(
    df: DataFrame, path: str, partition_by: list[str] | None = None, replace: str = "table"
) -> str:
    """Write a cleaned table as Parquet, optionally partitioned (e.g. by Year so
    that a year filter prunes whole folders).

    Rows are brought together by ``partition_by`` first with a rebalance, whose
    partitions adaptive execution sizes: small ones are merged, a value with
    very many rows is split, so a folder has about one file for each advisory
    size and no task writes to many folders. ``replace="partitions"`` overwrites
    only the folders of values that ``df`` holds; all others stay as they are.
    """
    if replace not in ("table", "partitions"):
        raise ValueError("replace must be 'table' or 'partitions'")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        writer = writer.option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    writer.parquet(path)
    return path
