"""Parquet tables in one shared folder, published in versions, and previews."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.sources.files import SharedFiles


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="wardstar-")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """A scan of fewer pieces than cores, dealt out to all cores by key.

    One row group, or one CSV file with quoted line breaks, is one task however
    large it is, and so would be every step up to the first shuffle. Choose keys
    few rows share. A scan with a piece per core is returned as it is, so what
    moves here is less than one split per core.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    pieces = rows.rdd.getNumPartitions()
    return rows.repartition(cores, *keys) if pieces < cores else rows


class Manifest(NamedTuple):
    """One published set of tables: their folders, and notes kept with them."""

    version: int
    tables: dict[str, str]
    notes: dict


class TableFolder:
    """Full-refresh tables, each a Parquet folder below one path, published as sets.

    A table lies in a new folder for every write. A set of them becomes visible by
    one new file, the manifest of the next version, so a reader that opens a version
    sees tables of one build only, also during a refresh.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.written: dict[str, str] = {}

    def write(self, name: str, rows: DataFrame) -> DataFrame:
        """Write the table to a new folder of its own and return it read back.

        A reader of an earlier one goes on undisturbed, and a write that fails
        replaces nothing. Reading back cuts the lineage and gives the planner true
        file sizes, so it broadcasts a side only when the written bytes are under
        the limit.
        """
        place = f"{name}/{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").parquet(f"{self.path}/{place}")
        self.written[name] = place
        return self.read(place)

    def read(self, place: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{place}")

    def versions(self) -> list[int]:
        """Published versions that are kept, oldest first."""
        names = self._files().names(f"{self.path}/manifests")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest | None:
        """A published version, by default the latest; nothing before the first."""
        found = self.versions() if version is None else [version]
        if not found:
            return None
        return Manifest(**json.loads(self._files().read(self._manifest(found[-1]))))

    def publish(self, names: Iterable[str], notes: dict, keep: int = 2) -> Manifest:
        """Make the last written tables of these names the next version.

        Versions before the last ``keep`` go, with the tables no kept version names.
        Keep two at least: a reader of the one before may still be at work.
        """
        files = self._files()
        tables = {name: self.written[name] for name in names}
        version = max(self.versions(), default=0) + 1
        while True:
            manifest = Manifest(version, tables, notes)
            if files.write_once(self._manifest(version), json.dumps(manifest._asdict())):
                break
            version += 1
        retired = [self.manifest(v) for v in self.versions()[:-keep]]
        kept = {p for v in self.versions()[-keep:] for p in self.manifest(v).tables.values()}
        for old in retired:
            # The manifest first: what it names must not be found once it is gone.
            files.delete(self._manifest(old.version))
            for place in set(old.tables.values()) - kept:
                files.delete(f"{self.path}/{place}")
        return manifest

    def _manifest(self, version: int) -> str:
        return f"{self.path}/manifests/{version:08d}.json"

    def _files(self) -> SharedFiles:
        return SharedFiles(self.spark, self.path)


def preview_json(rows: DataFrame, limit: int = 50) -> DataFrame:
    """The first rows as JSON text, nulls kept. Order the rows beforehand."""
    line = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return rows.limit(limit).select(line.alias("line"))
