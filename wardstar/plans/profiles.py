"""Profiles of the claim and coverage feeds, which no table is built from.

A profile reports figures in a fixed order and asserts nothing: n is a count,
of_n the rows it is a count of, amount a sum of money.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstar.functions.scalars import listed, text, zip_shape
from wardstar.operators import profiling as pro
from wardstar.operators.keys import union_all

ENCOUNTER = "APPOINTMENTID"
TYPE_COLUMNS = ("HEALTHCARECLAIMTYPEID1", "HEALTHCARECLAIMTYPEID2")


class Figure(NamedTuple):
    """One line of a profile, in SQL; with ``when``, only for rows that meet it."""

    sort: int
    figure: str
    n: str
    of_n: str = "null"
    amount: str = "null"
    when: str = "true"


def _figures(rows: DataFrame, *figures: Figure) -> DataFrame:
    """Figures (sort, figure, n, of_n, amount) of every row, in long form."""
    lines = ", ".join(
        f"if({f.when}, struct({f.sort}, {f.figure}, cast({f.n} as bigint), "
        f"cast({f.of_n} as bigint), cast({f.amount} as {pro.MONEY_SUM})), null)"
        for f in figures
    )
    return rows.selectExpr(
        f"inline(array_compact(array({lines}))) as (sort, figure, n, of_n, amount)"
    )


# The figures of the claim profile that count keys, by what they ask.
CLAIMS, TRANSACTIONS = "claims", "claim transactions"
REFERENCES: dict[int, tuple[str, str, str]] = {
    7: (CLAIMS, "PATIENTID", "patients"),
    8: (CLAIMS, "PROVIDERID", "providers"),
    9: (CLAIMS, "REFERRINGPROVIDERID", "providers"),
    10: (CLAIMS, "SUPERVISINGPROVIDERID", "providers"),
    11: (CLAIMS, ENCOUNTER, "encounters"),
    12: (TRANSACTIONS, "PATIENTID", "patients"),
    13: (TRANSACTIONS, "PROVIDERID", "providers"),
    14: (TRANSACTIONS, "SUPERVISINGPROVIDERID", "providers"),
    15: (TRANSACTIONS, ENCOUNTER, "encounters"),
    16: (TRANSACTIONS, "CLAIMID", "claims"),
}
SENTINEL_TEXT = "claims whose PRIMARYPATIENTINSURANCEID is the self-pay sentinel 0"
PAYER_TEXT = "encounters whose PAYER is missing or does not resolve"
BILLED_TEXT = "encounters, TOTAL_CLAIM_COST summed"
FILLED = ("AMOUNT", "PAYMENTS", "TRANSFERS")
PARENT_KEYS = {"patients": "Id", "providers": "Id", "encounters": "Id", CLAIMS: "Id", "payers": "Id"}

#: Domains of the claim ledger; the last two hold no keys but categories.
DOMAINS = ("patients", "providers", "encounters", CLAIMS, "payers", TRANSACTIONS, "sentinel", "types")
SLOTS = 8


class Tag(NamedTuple):
    """One use of a feed's row in the ledger: its domain, slot and key, and what to add up."""

    domain: str
    slot: int | str
    key: str
    money: str = "null"
    categories: tuple[str, str] = ("null", "null")


def _reference_slots() -> dict[int, int]:
    """The slot of each reference in its parent's domain; the parent's own key has 0."""
    taken: dict[str, int] = {}
    found = {}
    for sort, (_, _, parent) in REFERENCES.items():
        taken[parent] = found[sort] = taken.get(parent, 0) + 1
    return found


REFERENCE_SLOTS = _reference_slots()


def _tags() -> dict[str, list[Tag]]:
    """By feed, what every row of it adds to the ledger."""
    found: dict[str, list[Tag]] = {feed: [Tag(feed, 0, key)] for feed, key in PARENT_KEYS.items()}
    found[TRANSACTIONS] = [Tag(TRANSACTIONS, 0, "ID")]
    for sort, (feed, column, parent) in REFERENCES.items():
        mixing = (feed, parent) == (CLAIMS, "encounters")
        # Hashes, because the least and greatest of numbers merge without a sort.
        labels = tuple(f"xxhash64(coalesce(`{c}`, {text(pro.NULL_LABEL)}))" for c in TYPE_COLUMNS)
        found[feed].append(
            Tag(parent, REFERENCE_SLOTS[sort], column, categories=labels if mixing else ("null", "null"))
        )
    found["encounters"].append(Tag("payers", 1, "PAYER", money="TOTAL_CLAIM_COST"))
    found[CLAIMS].append(Tag("sentinel", 0, "PRIMARYPATIENTINSURANCEID = '0'"))
    # Which of its columns a transaction fills is one of eight slots, a bit for each.
    bits = " + ".join(f"if(`{c}` is null, 0, {1 << i})" for i, c in enumerate(FILLED))
    found[TRANSACTIONS].append(Tag("types", bits, "TYPE", money="AMOUNT"))
    return found


def _ledger(feeds: dict[str, DataFrame]) -> DataFrame:
    """All six feeds in one grouping by (key, domain), each scanned once; null is a key too.

    Where a task has more keys than memory, Spark sorts them, by the first bytes of the
    first column as long as those differ. So the key stands first: behind the domain, which
    millions of rows share, each comparison would read two whole rows.
    """

    def line(tag: Tag) -> str:
        return (
            f"{DOMAINS.index(tag.domain)}, {tag.slot}, "
            f"cast({tag.key} as string), cast({tag.money} as {pro.MONEY}), "
            + ", ".join(f"cast({c} as bigint)" for c in tag.categories)
        )

    columns = "domain, slot, domain_key, money, first_type, second_type"
    parts = [
        feeds[feed].selectExpr(f"stack({len(tags)}, {', '.join(map(line, tags))}) as ({columns})")
        for feed, tags in _tags().items()
    ]
    # One empty row for each domain of keys, so that an empty feed has its zeros.
    none = ", ".join(f"{i}, -1, null, null, null, null" for i in range(len(DOMAINS) - 1))
    spark = parts[0].sparkSession
    empty = spark.range(1).selectExpr(f"stack({len(DOMAINS) - 1}, {none}) as ({columns})")
    typed = empty.selectExpr(
        "domain", "slot", "cast(domain_key as string)", f"cast(money as {pro.MONEY})",
        "cast(first_type as bigint)", "cast(second_type as bigint)",
    )
    return (
        union_all([*parts, typed])
        .groupBy("domain_key", "domain")
        .agg(
            *[F.expr(f"count_if(slot = {i}) as n{i}") for i in range(SLOTS)],
            F.expr(f"cast(sum(money) as {pro.MONEY_SUM}) as money"),
            *[
                F.expr(f"{side}({c}) as {c}_{side}")
                for c in ("first_type", "second_type")
                for side in ("min", "max")
            ],
        )
        .withColumnRenamed("domain_key", "key")
    )


class KeyedFigure(NamedTuple):
    """A figure over the keys of a domain: its text and what each key adds, in SQL."""

    sort: int
    figure: str
    n: str
    of_n: str = "null"
    merged_by: str = "sum"
    amount: bool = False


def _keyed_figures() -> dict[str, list[KeyedFigure]]:
    found: dict[str, list[KeyedFigure]] = {domain: [] for domain in DOMAINS[:-1]}
    for first, plural, key in ((1, CLAIMS, "Id"), (4, TRANSACTIONS, "ID")):
        found[plural] += [
            KeyedFigure(first, plural, "n0"),
            KeyedFigure(
                first + 1, f"{plural} with a distinct {key}", "if(key is not null and n0 > 0, 1, 0)", "n0"
            ),
            KeyedFigure(first + 2, f"{plural} with a null {key}", "if(key is null, n0, 0)", "n0"),
        ]
    for sort, (plural, column, parent) in REFERENCES.items():
        mine = f"n{REFERENCE_SLOTS[sort]}"
        suffix = " to an encounter" if parent == "encounters" else ""
        found[parent].append(
            KeyedFigure(
                sort,
                f"{plural} whose {column} does not resolve{suffix}",
                f"if(key is not null and n0 = 0, {mine}, 0)",
                f"if(key is not null, {mine}, 0)",
            )
        )
    claims = f"if(key is null, 0, n{REFERENCE_SLOTS[11]})"
    parent = "if(n0 > 0, 1, 0)"
    found["encounters"] += [
        KeyedFigure(17, "encounters with no claim", f"if(n0 > 0 and {claims} = 0, 1, 0)", parent),
        KeyedFigure(
            18, "encounters with exactly one claim", f"if(n0 > 0 and {claims} = 1, 1, 0)", parent
        ),
        KeyedFigure(
            19, "most claims on one encounter", f"if(n0 > 0, {claims}, null)", merged_by="max"
        ),
        *[
            KeyedFigure(
                20 + i,
                f"encounters whose claims carry more than one {column}",
                f"if(n0 > 0 and key is not null and {c}_min != {c}_max, 1, 0)",
                parent,
            )
            for i, (column, c) in enumerate(zip(TYPE_COLUMNS, ("first_type", "second_type"), strict=True))
        ],
    ]
    found["sentinel"].append(KeyedFigure(27, SENTINEL_TEXT, "if(key = 'true', n0, 0)", "n0"))
    found["payers"] += [
        KeyedFigure(28, PAYER_TEXT, "if(key is null or n0 = 0, n1, 0)", "n1"),
        KeyedFigure(30, BILLED_TEXT, "n1", amount=True),
    ]
    return found


KEYED_FIGURES = _keyed_figures()


def _summed_domains(ledger: DataFrame) -> DataFrame:
    """One row for each domain of keys, and for each type of transaction.

    ``n<j>`` and ``of<j>`` belong to the j-th figure of the row's domain.
    """
    width = max(map(len, KEYED_FIGURES.values()))
    numbered = {DOMAINS.index(domain): figures for domain, figures in KEYED_FIGURES.items()}
    sums = []
    for j in range(width):
        there = {i: figures[j] for i, figures in numbered.items() if j < len(figures)}
        for name, part in ((f"n{j}", "n"), (f"of{j}", "of_n")):
            for merge in ("sum", "max"):
                cases = "".join(
                    f"when {i} then cast({getattr(f, part)} as bigint) "
                    for i, f in there.items()
                    if f.merged_by == merge and getattr(f, part) != "null"
                )
                value = f"case domain {cases}end" if cases else "cast(null as bigint)"
                sums.append(f"{merge}({value}) as {name}_{merge}")
    kept = [f"coalesce({n}{j}_sum, {n}{j}_max) as {n}{j}" for j in range(width) for n in ("n", "of")]
    types = DOMAINS.index("types")
    # All transactions of a type, then those that fill each column.
    masks = [0, *(1 << i for i in range(len(FILLED)))]
    totals = [" + ".join(f"n{slot}" for slot in range(SLOTS) if slot & m == m) for m in masks]
    return (
        ledger.groupBy("domain", F.expr(f"if(domain = {types}, key, null) as type"))
        .agg(
            *[F.expr(s) for s in sums],
            F.expr(f"cast(sum(money) as {pro.MONEY_SUM}) as money"),
            *[F.expr(f"sum({total}) as total{i}") for i, total in enumerate(totals)],
        )
        .selectExpr("domain", "type", "money", *kept, *[f"total{i}" for i in range(len(masks))])
    )


def profile_claims(
    claims: DataFrame,
    transactions: DataFrame,
    encounters: DataFrame,
    patients: DataFrame,
    providers: DataFrame,
    payers: DataFrame,
) -> DataFrame:
    """Thirty figures about claims and their transactions, from the raw feeds.

    Every feed is read once: a row adds one line to a ledger for each key or category
    it carries, and one grouping of all lines holds what every figure needs.
    """
    feeds = {
        CLAIMS: claims, TRANSACTIONS: transactions, "encounters": encounters,
        "patients": patients, "providers": providers, "payers": payers,
    }
    sums = _summed_domains(_ledger(feeds))
    keyed = [
        Figure(
            f.sort, text(f.figure), f"n{j}", f"of{j}", "money" if f.amount else "null",
            when=f"domain = {DOMAINS.index(domain)}",
        )
        for domain, figures in KEYED_FIGURES.items()
        for j, f in enumerate(figures)
    ]
    types = DOMAINS.index("types")
    # Over the sums, a row for each type; a second read of them would read the feeds again.
    n_transactions = F.sum("total0").over(Window.partitionBy("domain"))
    label = f"concat('claim transactions typed ', coalesce(type, {text(pro.NULL_LABEL)}))"

    def filled(sort: int, kind: str, words: str, column: str) -> Figure:
        figure = text(f"{kind} transactions with {words}")
        total = f"total{1 + FILLED.index(column)}"
        return Figure(sort, figure, total, "total0", when=f"domain = {types} and type = '{kind}'")

    by_type = [
        Figure(22, label, "total0", "n_transactions", when=f"domain = {types}"),
        filled(23, "PAYMENT", "an AMOUNT", "AMOUNT"),
        filled(24, "PAYMENT", "PAYMENTS", "PAYMENTS"),
        filled(25, "TRANSFEROUT", "an AMOUNT", "AMOUNT"),
        filled(26, "TRANSFEROUT", "TRANSFERS", "TRANSFERS"),
        Figure(
            29, text("CHARGE transactions, AMOUNT summed"), "total0", amount="money",
            when=f"domain = {types} and type = 'CHARGE'",
        ),
    ]
    found = _figures(sums.withColumn("n_transactions", n_transactions), *keyed, *by_type)
    return found.orderBy("sort", "figure").select("figure", "n", "of_n", "amount")


def profile_payer_transitions(transitions: DataFrame, dim_payer: DataFrame) -> DataFrame:
    """Coverage spans by the financial class of their two payers.

    Spans are counted per pair of payers before the payers are looked up, in
    their two roles; every figure is then a sum over those few pairs.
    """
    pairs = transitions.groupBy("PAYER", "SECONDARY_PAYER").agg(F.expr("count(*) as uses"))
    classes = dim_payer.select("payer_id", "payer_financial_class")
    first = classes.toDF("PAYER", "primary_class")
    second = classes.toDF("SECONDARY_PAYER", "secondary_class")
    spans = pairs.join(first, "PAYER", "left").join(second, "SECONDARY_PAYER", "left")

    def total(condition: str, name: str) -> Column:
        return F.expr(f"coalesce(sum(if({condition}, uses, 0)), 0) as {name}")

    has_second, dual = "SECONDARY_PAYER is not null", "primary_class = 'dual_eligible'"
    one_row = spans.agg(
        total("true", "n_all"),
        total("primary_class is null", "lost_primary"),
        total(f"{has_second} and secondary_class is null", "lost_secondary"),
        total(has_second, "n_second"),
        total(dual, "n_dual"),
        total(f"{dual} and {has_second}", "n_dual_second"),
    )
    fixed = _figures(
        one_row,
        Figure(1, text("coverage spans"), "n_all"),
        Figure(2, text("spans whose primary payer does not resolve"), "lost_primary", "n_all"),
        Figure(3, text("spans whose secondary payer does not resolve"), "lost_secondary", "n_all"),
        Figure(4, text("spans with a secondary payer"), "n_second", "n_all"),
        Figure(6, text("spans whose primary payer is dual eligible"), "n_dual", "n_all"),
        Figure(7, text("dual eligible spans with a secondary payer"), "n_dual_second", "n_dual"),
    )
    by_class = (
        spans.where(has_second)
        .groupBy("primary_class", "secondary_class")
        .agg(F.expr("sum(uses) as uses"))
        .withColumn("n_second", one_row.select("n_second").scalar())
    )
    label = """concat('spans with a secondary payer, ', primary_class, ' primary and ',
        secondary_class, ' secondary')"""
    varying = _figures(by_class, Figure(5, label, "uses", "n_second"))
    return (
        fixed.union(varying)
        .orderBy("sort", F.asc_nulls_last("figure"))
        .select("figure", "n", "of_n")
    )


#: The shapes each staged table's ZIP codes may have; null is always one.
#: Patients' are cut to a prefix, so any but five digits would publish a wrong area.
PERMITTED_ZIPS: dict[str, tuple[str, ...]] = {
    "stg_patients": ("five digits",),
    "stg_organizations": ("ZIP+4", "five digits", "four digits"),
    "stg_providers": ("ZIP+4", "five digits", "four digits"),
}


def profile_zip_shapes(tables: Callable[[str], DataFrame]) -> DataFrame:
    """(table_name, shape, n, is_permitted): the shapes of the staged ZIP codes."""
    parts = []
    for table, permitted in PERMITTED_ZIPS.items():
        shapes = tables(table).selectExpr(f"{zip_shape('zip_code')} as shape").groupBy("shape")
        parts.append(
            shapes.agg(F.expr("count(*) as n")).selectExpr(
                f"{text(table)} as table_name",
                "shape",
                "n",
                f"shape is null or shape in ({listed(permitted)}) as is_permitted",
            )
        )
    return union_all(parts)


def unexpected_zips(tables: Callable[[str], DataFrame], table: str) -> DataFrame:
    """Rows of a staged table whose ZIP code has a shape it may not have."""
    shape = zip_shape("zip_code")
    return tables(table).where(f"{shape} not in ({listed(PERMITTED_ZIPS[table])})")
