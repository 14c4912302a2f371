"""Raw feeds: all-text CSV files with a header, one folder or file per feed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.sources.files import SharedFiles

# The columns read from each raw feed. A feed may carry more;
# those are never parsed.
FEED_COLUMNS: dict[str, tuple[str, ...]] = {
    "claims": (
        "Id", "PATIENTID", "PROVIDERID", "REFERRINGPROVIDERID", "SUPERVISINGPROVIDERID",
        "APPOINTMENTID", "PRIMARYPATIENTINSURANCEID", "HEALTHCARECLAIMTYPEID1",
        "HEALTHCARECLAIMTYPEID2",
    ),
    "claims_transactions": (
        "ID", "CLAIMID", "PATIENTID", "PROVIDERID", "SUPERVISINGPROVIDERID", "APPOINTMENTID",
        "TYPE", "AMOUNT", "PAYMENTS", "TRANSFERS",
    ),
    "conditions": ("PATIENT", "ENCOUNTER", "START", "STOP", "CODE", "DESCRIPTION"),
    "encounters": (
        "Id", "PATIENT", "ORGANIZATION", "PROVIDER", "PAYER", "START", "STOP",
        "ENCOUNTERCLASS", "CODE", "DESCRIPTION", "REASONCODE", "REASONDESCRIPTION",
        "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "PAYER_COVERAGE",
    ),
    "organizations": (
        "Id", "NAME", "ADDRESS", "CITY", "STATE", "ZIP", "LAT", "LON", "PHONE", "REVENUE",
        "UTILIZATION",
    ),
    "patients": (
        "Id", "BIRTHDATE", "DEATHDATE", "PREFIX", "FIRST", "LAST", "SUFFIX", "MAIDEN",
        "MARITAL", "RACE", "ETHNICITY", "GENDER", "BIRTHPLACE", "ADDRESS", "CITY", "STATE",
        "COUNTY", "ZIP", "LAT", "LON", "HEALTHCARE_EXPENSES", "HEALTHCARE_COVERAGE",
    ),
    "payer_transitions": ("PAYER", "SECONDARY_PAYER"),
    "payers": (
        "Id", "NAME", "ADDRESS", "CITY", "STATE_HEADQUARTERED", "ZIP", "PHONE",
        "AMOUNT_COVERED", "AMOUNT_UNCOVERED", "REVENUE",
        "COVERED_ENCOUNTERS", "UNCOVERED_ENCOUNTERS", "COVERED_MEDICATIONS",
        "UNCOVERED_MEDICATIONS", "COVERED_PROCEDURES", "UNCOVERED_PROCEDURES",
        "COVERED_IMMUNIZATIONS", "UNCOVERED_IMMUNIZATIONS", "UNIQUE_CUSTOMERS",
        "MEMBER_MONTHS", "QOLS_AVG",
    ),
    "providers": (
        "Id", "ORGANIZATION", "NAME", "GENDER", "SPECIALITY", "ADDRESS", "CITY", "STATE",
        "ZIP", "LAT", "LON", "UTILIZATION",
    ),
}


def read_feed(
    spark: SparkSession, feed: str, path: str, *, multi_line: bool = True
) -> DataFrame:
    """One raw feed as text columns, found by header name.

    Without a schema and without inference every column is text, and the header
    of every file is checked against the first. Quoted fields may hold doubled
    quotes and line breaks; an empty field is null. ``multi_line=False`` lets
    Spark split large files and is right only for a feed without line breaks
    inside fields; with it, deliver a large feed as many files.
    """
    rows = spark.read.csv(
        path,
        header=True,
        inferSchema=False,
        enforceSchema=False,
        multiLine=multi_line,
        quote='"',
        escape='"',
        mode="FAILFAST",
    )
    missing = [c for c in FEED_COLUMNS[feed] if c not in rows.columns]
    if missing:
        raise ValueError(f"feed {feed} at {path} lacks the columns {missing}")
    rows = rows.select(*FEED_COLUMNS[feed])
    # A file with line breaks inside fields is read by one task; what follows is not.
    if multi_line and not _even_files(spark, path):
        return rows.repartition(F.xxhash64(*rows.columns))
    return rows


def _even_files(spark: SparkSession, path: str) -> bool:
    """Whether a path holds files for all cores, none of which has twice a core's share."""
    files = SharedFiles(spark, path)
    if not files.exists(path):
        return False
    sizes = [f.size for f in files.all_files(path)]
    return max(sizes, default=0) * spark.sparkContext.defaultParallelism < 2 * sum(sizes)


def csv_feeds(
    spark: SparkSession, folder: str, *, multi_line: bool = True
) -> Mapping[str, DataFrame]:
    """The nine feeds of one delivery, ``<folder>/<feed>.csv`` each.

    Feeds are opened on first use, so a job needs only the files it reads.
    """
    return LazyFeeds(
        lambda feed: read_feed(spark, feed, f"{folder}/{feed}.csv", multi_line=multi_line)
    )


class LazyFeeds(Mapping):
    """Feeds by name, each opened on first use."""

    def __init__(self, open_feed):
        self._open = open_feed
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, feed: str) -> DataFrame:
        if feed not in FEED_COLUMNS:
            raise KeyError(feed)
        if feed not in self._frames:
            self._frames[feed] = self._open(feed)
        return self._frames[feed]

    def __iter__(self):
        return iter(FEED_COLUMNS)

    def __len__(self) -> int:
        return len(FEED_COLUMNS)


def write_feed(rows: DataFrame, path: str) -> None:
    """Write rows as the CSV text ``read_feed`` reads."""
    rows.write.mode("overwrite").csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
