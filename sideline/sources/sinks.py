"""Sinks. Writes are the only actions a job performs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row (a folder of part files). Quotes are doubled, as spreadsheets
    and data-frame libraries write them, and outer blanks of a value are kept; read values
    that hold line breaks back with ``read_csv(..., multi_line=True)``."""
    (df.write.mode(mode).option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_parquet(df: DataFrame, path: str, partitions: Sequence[str] | None = None,
                  mode: str = "overwrite", balance: bool = True) -> None:
    """Parquet, optionally Hive-partitioned by ``partitions`` (NULL values land in
    ``__HIVE_DEFAULT_PARTITION__`` and read back as NULL).

    With ``balance`` a partitioned write is first rebalanced on the partition columns:
    rows of one folder meet in one task (few files), and AQE, which knows the sizes,
    merges small tasks and splits those of a hot folder into several files.
    """
    w = df.hint("rebalance", *[F.col(p) for p in partitions]) if partitions and balance else df
    writer = w.write.mode(mode)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)


@dataclass(frozen=True)
class StarPaths:
    """Output folders of the star schema under one prefix (trailing '/' ignored)."""
    prefix: str

    @property
    def base(self) -> str:
        return self.prefix.rstrip("/")

    def __getitem__(self, table: str) -> str:
        return f"{self.base}/{table}"

    dim_player = property(lambda self: self["dim_player"])
    dim_team = property(lambda self: self["dim_team"])
    dim_injury = property(lambda self: self["dim_injury"])
    dim_date = property(lambda self: self["dim_date"])
    fact_injury = property(lambda self: self["fact_injury"])
