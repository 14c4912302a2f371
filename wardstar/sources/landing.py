"""Where deliveries arrive: raw feeds as CSV, in a folder apart from any star.

Only the columns a feed is read for are put here, so identifiers that no table needs
never reach the disk, and nothing raw lies beside published tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from wardstar.sources.feeds import FEED_COLUMNS, csv_feeds, write_feed
from wardstar.sources.tables import shared_folder


class Landing:
    """One delivery, ``<folder>/<feed>.csv`` for each feed."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{shared_folder(spark)}/landing/{uuid.uuid4().hex}"

    def put(self, feed: str, rows: DataFrame) -> None:
        """Write a feed as many files; columns that nothing reads are left out."""
        write_feed(rows.select(*FEED_COLUMNS[feed]), f"{self.folder}/{feed}.csv")

    def feeds(self, *, multi_line: bool = True) -> Mapping[str, DataFrame]:
        return csv_feeds(self.spark, self.folder, multi_line=multi_line)
