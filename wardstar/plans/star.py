"""The fifteen tables of the star over one set of raw feeds."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from threading import Lock
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardstar.operators.ledger import key_ledger
from wardstar.operators.privacy import (
    AGED_FACTS,
    PUBLISHED_DATES,
    age_guard,
    last_seen,
    patient_marks,
    published_periods,
)
from wardstar.plans import dimensions, facts, rules
from wardstar.plans.evidence import (
    KEY_KINDS,
    OBSERVED_KINDS,
    USES,
    Evidence,
    key_part,
    observed,
    suspects,
)
from wardstar.plans.staging import stage
from wardstar.sources.files import SharedFiles
from wardstar.sources.order_feeds import order_feeds
from wardstar.sources.tables import Manifest, TableFolder, shared_folder


class Model(NamedTuple):
    """How one table is computed, and from which tables or feeds."""

    compute: Callable[..., DataFrame]
    inputs: tuple[str, ...]


def _staging(feed: str) -> Model:
    return Model(lambda rows: stage(feed, rows), (f"feed_{feed}",))


# In build order: every table follows its inputs.
MODELS: dict[str, Model] = {
    "stg_conditions": _staging("conditions"),
    "stg_encounters": _staging("encounters"),
    "stg_organizations": _staging("organizations"),
    "stg_patients": _staging("patients"),
    "stg_payers": _staging("payers"),
    "stg_providers": _staging("providers"),
    "dim_condition": Model(dimensions.dim_condition, ("stg_conditions",)),
    "dim_date": Model(dimensions.dim_date, ("stg_encounters",)),
    "dim_encounter_type": Model(dimensions.dim_encounter_type, ("stg_encounters",)),
    "dim_organization": Model(dimensions.dim_organization, ("stg_organizations",)),
    "dim_patient": Model(dimensions.dim_patient, ("stg_patients", "patient_last_seen")),
    "dim_payer": Model(dimensions.dim_payer, ("stg_payers",)),
    "dim_provider": Model(dimensions.dim_provider, ("stg_providers",)),
    "fct_condition": Model(
        facts.fct_condition, ("stg_conditions", "stg_encounters", "age_guard")
    ),
    "fct_encounter": Model(
        facts.fct_encounter, ("stg_encounters", "stg_conditions", "age_guard")
    ),
}

_ALL = tuple(MODELS)
_FACTS = tuple(p.fact for p in AGED_FACTS)


def _lookup(frames: tuple[DataFrame, ...]) -> Callable[[str], DataFrame]:
    return dict(zip(_ALL, frames, strict=True)).__getitem__


# Tables that several readers share. Written, their size is known, so a side is
# broadcast only while it is small. The last three are what the rules are answered from.
SHARED: dict[str, Model] = {
    "patient_last_seen": Model(
        lambda *rows: last_seen(dict(zip(PUBLISHED_DATES, rows))), tuple(PUBLISHED_DATES)
    ),
    "age_guard": Model(age_guard, ("stg_patients", "dim_patient")),
    "key_ledger": Model(lambda *frames: key_ledger(_lookup(frames), USES), _ALL),
    "patient_marks": Model(
        lambda *rows: patient_marks(published_periods(dict(zip(_FACTS, rows)).__getitem__)), _FACTS
    ),
    "suspect_periods": Model(
        lambda marks, *frames: suspects(marks, _lookup(frames)), ("patient_marks", *_ALL)
    ),
}
EVIDENCE = ("key_ledger", "patient_marks", "suspect_periods")

BUILD_STEPS = (
    tuple(name for name in MODELS if name.startswith("stg_")),
    ("patient_last_seen", *[n for n in MODELS if n.startswith("dim_") and n != "dim_patient"]),
    ("dim_patient",),
    ("age_guard",),
    tuple(name for name in MODELS if name.startswith("fct_")),
)


def _with_inputs(names: Iterable[str]) -> set[str]:
    """These tables and all they are computed from, without the raw feeds."""
    found = set(names)
    for name in names:
        inputs = (MODELS.get(name) or SHARED[name]).inputs
        found |= _with_inputs([i for i in inputs if not i.startswith("feed_")])
    return found


class Star:
    """Tables of the star, written to Parquet when another table reads them.

    ``lazy(name)`` is the plan of a table over its written inputs; ``table(name)``
    is the written table. Each is written at most once per ``Star``, so a rule
    set over all tables parses no feed twice and recomputes no cohort.
    """

    def __init__(self, spark: SparkSession, feeds: Mapping[str, DataFrame], folder: str):
        self.feeds = feeds
        self.folder = TableFolder(spark, folder)
        # Helpers that hold birth dates or raw rows lie apart from what is published.
        self.work = TableFolder(spark, f"{self.folder.path}-work")
        self._written: dict[str, DataFrame] = {}
        self._locks: defaultdict[str, Lock] = defaultdict(Lock)
        self._guard = Lock()
        self.figures: dict[str, int] = {}
        # Figures cost time in every write, so only a build for the rules observes them.
        self._observing = False

    def lazy(self, name: str) -> DataFrame:
        model = MODELS.get(name) or SHARED[name]
        return model.compute(*[self.table(i) for i in model.inputs])

    def table(self, name: str) -> DataFrame:
        """A written table, or with ``feed_<name>`` the raw feed as it is."""
        if name.startswith("feed_"):
            return self.feeds[name.removeprefix("feed_")]
        return self._model_table(name)

    def _once(self, name: str, rows: Callable[[], DataFrame]) -> DataFrame:
        """Write a table unless another thread has; inputs are locked after their users."""
        with self._guard:
            lock = self._locks[name]
        with lock:
            if name not in self._written:
                place = self.folder if name in MODELS or name in EVIDENCE else self.work
                self._written[name] = place.write(name, rows())
            return self._written[name]

    def _noting(self, name: str, rows: DataFrame, notes: list) -> DataFrame:
        """The rows, with the figures the rules ask of them observed as they pass."""
        figures = observed(name) if self._observing else {}
        if not figures:
            return rows
        note = Observation()
        notes.append((note, list(figures)))
        aggregates = [F.expr(f).alias(f"f{i}") for i, f in enumerate(figures.values())]
        return rows.observe(note, *aggregates)

    def _model_table(self, name: str) -> DataFrame:
        """Write a model once and keep the figures that were observed meanwhile."""
        notes: list[tuple[Observation, list[str]]] = []

        def rows() -> DataFrame:
            model = MODELS.get(name) or SHARED[name]
            inputs = [
                self._noting(i, self.table(i), notes) if i.startswith("feed_") else self.table(i)
                for i in model.inputs
            ]
            return self._noting(name, model.compute(*inputs), notes)

        written = self._once(name, rows)
        for note, figures in notes:
            self.figures.update((f, note.get[f"f{i}"]) for i, f in enumerate(figures))
        return written

    def build(self, names: Iterable[str] = _ALL, threads: int = 4) -> dict[str, DataFrame]:
        """Write the tables of these names that are not written yet, and return them.

        Tables of one step do not read each other and are written side by side,
        so a small dimension does not leave the cluster idle.
        """
        wanted = _with_inputs(names)
        with ThreadPoolExecutor(threads) as pool:
            for step in BUILD_STEPS:
                list(pool.map(self.table, [name for name in step if name in wanted]))
        return {name: self.table(name) for name in names}

    def evidence(self, kind: str | None = None) -> Evidence:
        """What the rules, or only the generic rules of one kind, are answered from.

        For one kind the tables it asks about are written and no other evidence; rules
        on keys then count their own keys only, unless the whole ledger is there.
        """
        self._observing = True
        if kind in OBSERVED_KINDS:
            asked = [name.replace("feed_", "stg_") for name in OBSERVED_KINDS[kind]]
            self._count(self.build([name for name in asked if name in MODELS]))
            return Evidence(self.figures)
        if kind in KEY_KINDS and "key_ledger" not in self._written:
            uses, figures = key_part(kind)
            self.build({use.table for use in uses.values()})
            ledger = key_ledger(self.table, uses)
            return Evidence(self.figures, ledger, uses=uses, key_figures=figures)
        self._count(self.build())
        return Evidence(self.figures, *[self.table(name) for name in EVIDENCE])

    def _count(self, names: Iterable[str]) -> None:
        """The figures of tables, and of their feeds, that were written before anyone asked."""
        for name in {i for n in names for i in (n, *MODELS[n].inputs)}:
            missing = {f: sql for f, sql in observed(name).items() if f not in self.figures}
            if missing:
                aggregates = [F.expr(sql).alias(f"f{i}") for i, sql in enumerate(missing.values())]
                counted = self.table(name).agg(*aggregates).first()
                self.figures.update(zip(missing, counted, strict=True))

    def release(
        self, tolerated: dict[str, tuple[int, int]] = rules.TOLERATED, keep: int = 2
    ) -> Manifest:
        """Build, check, and publish the fifteen tables and their rule summary as one version.

        Raises ``rules.RulesBroken`` and publishes nothing where a rule has status
        ``error``; earlier versions stay as they are.
        """
        evidence = self.evidence()
        summary = rules.rule_summary(self.folder.spark, self.table, tolerated, evidence)
        rules.gate(self.folder.write("rule_summary", summary))
        return self.folder.publish(
            [*MODELS, *EVIDENCE, "rule_summary"], {"figures": self.figures}, keep
        )


class PublishedStar:
    """The tables of one published version, as any process reads them."""

    def __init__(self, spark: SparkSession, folder: str, version: int | None = None):
        self.folder = TableFolder(spark, folder)
        manifest = self.folder.manifest(version)
        if manifest is None:
            raise FileNotFoundError(f"no version is published in {folder}")
        self.manifest = manifest

    def table(self, name: str) -> DataFrame:
        return self.folder.read(self.manifest.tables[name])

    def evidence(self) -> Evidence:
        return Evidence(self.manifest.notes["figures"], *[self.table(name) for name in EVIDENCE])


_STARS: dict[tuple[str, str, str], Star] = {}
_STARS_LOCK = Lock()


def files_digest(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of all files in a folder; the driver lists them, no job runs."""
    listed = sorted(SharedFiles(spark, folder).all_files(folder))
    return hashlib.sha256(repr(listed).encode()).hexdigest()


def star_over_orders(spark: SparkSession, sf_dir: str) -> Star:
    """The star over the order tables in ``sf_dir``, one per Spark application and input.

    Its tables lie in the shared folder under the application's id, so another run
    never reads them. Once the files in ``sf_dir`` change, a new star is written.
    """
    application = spark.sparkContext.applicationId
    key = (application, sf_dir, files_digest(spark, sf_dir))
    with _STARS_LOCK:
        if key not in _STARS:
            digest = hashlib.sha256(repr(key[1:]).encode()).hexdigest()[:12]
            folder = f"{shared_folder(spark)}/wardstar/{application}/{digest}"
            _STARS[key] = Star(spark, order_feeds(spark, sf_dir), folder)
        return _STARS[key]
