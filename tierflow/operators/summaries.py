"""Grouped summaries (A2–A14) and the enriched entity projection.

A summary is ``groupBy(keys).agg(measures)``: Catalyst plans a partial hash
aggregate before the shuffle and a final one after it, so a hot key is
collapsed map-side and the shuffle carries one row per key per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.expressions import guarded_ratio, population_tier, size_category


# ---- measures ---------------------------------------------------------------
def row_count(alias: str = "country_count") -> Column:
    """Rows per group."""
    return F.count(F.lit(1)).alias(alias)


def total(column: str, alias: str) -> Column:
    """Sum; NULLs skipped, an all-NULL group gives NULL."""
    return F.sum(column).alias(alias)


def true_count(column: str, alias: str) -> Column:
    """Sum of the boolean as int — NULL (not 0) for an all-NULL group."""
    return F.sum(F.col(column).cast("int")).alias(alias)


def latest(column: str = "source_ingested_at", alias: str | None = None) -> Column:
    """A10: max timestamp (lineage)."""
    return F.max(column).alias(alias or column)


def distinct_with_null(column: Column | str) -> Column:
    """Distinct values counting NULL as one value (0 on an empty input)."""
    c = column if isinstance(column, Column) else F.col(column)
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


# ---- summarize ----------------------------------------------------------------
def summarize(
    df: DataFrame,
    keys: Sequence[Column | str],
    measures: Sequence[Column],
    updated_at: Column | None = None,
) -> DataFrame:
    """Group ``df`` by ``keys`` and compute ``measures``; optionally stamp ``updated_at``."""
    out = df.groupBy(*keys).agg(*measures)
    if updated_at is not None:
        out = out.withColumn("updated_at", updated_at)
    return out


@dataclass(frozen=True)
class SummarySpec:
    """A named gold summary: grouping keys and measures, built lazily."""

    name: str
    keys: Callable[[], list[Column]]
    measures: Callable[[], list[Column]]
    comment: str

    def build(self, silver: DataFrame, updated_at: Column | None = None) -> DataFrame:
        return summarize(silver, self.keys(), self.measures(), updated_at)


def _with_area() -> list[Column]:
    return [
        row_count(),
        total("population", "total_population"),
        total("area", "total_area_km2"),
        true_count("un_member", "un_member_count"),
        latest(),
    ]


# --- fixed values: the five published summaries (names, keys, measures, comments) ---
GOLD_SUMMARIES: tuple[SummarySpec, ...] = (
    SummarySpec(
        "countries_by_region",
        lambda: [F.col("region"), F.col("subregion")],
        _with_area,
        "One row per region and subregion: entities, people, area, UN members.",
    ),
    SummarySpec(
        "countries_by_continent",
        lambda: [F.col("region").alias("continent")],
        _with_area,
        "One row per continent (the region of the entities): entities, people, area, UN members.",
    ),
    SummarySpec(
        "population_tiers",
        lambda: [population_tier("population").alias("population_tier")],
        lambda: [row_count(), total("population", "total_population"), latest()],
        "Entities and people per population tier; an unknown population is in the lowest.",
    ),
    SummarySpec(
        "landlocked_vs_coastal",
        lambda: [F.col("region"), F.col("landlocked")],
        lambda: [
            row_count(),
            total("population", "total_population"),
            total("area", "total_area_km2"),
            latest(),
        ],
        "Per region, entities without and with a coast: number, people, area.",
    ),
    SummarySpec(
        "un_membership_summary",
        lambda: [F.col("region"), F.col("un_member")],
        lambda: [row_count(), total("population", "total_population"), latest()],
        "Per region, UN members and others: number and people.",
    ),
)
ENRICHED_NAME = "countries"
ENRICHED_COMMENT = "Every entity with its density and size bucket."
SILVER_COMMENT = "The newest batch as typed rows, one per key; source_ingested_at is the batch's stamp."
# ---------------------------------------------------------------------------------------

SUMMARY_BY_NAME = {s.name: s for s in GOLD_SUMMARIES}


def enrich(silver: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """The enriched entity table — pass-through columns, density, size bucket, lineage.

    A narrow projection (no shuffle); the output column order is fixed.
    """
    cols = [
        "name_common",
        "name_official",
        "cca2",
        "cca3",
        "region",
        "subregion",
        "population",
        "area",
    ]
    out = [F.col(c) for c in cols] + [
        guarded_ratio("population", "area", 2).alias("population_density"),
        size_category("area").alias("size_category"),
        F.col("landlocked"),
        F.col("un_member"),
        F.col("source_ingested_at"),
    ]
    if updated_at is not None:
        out.append(updated_at.alias("updated_at"))
    return silver.select(*out)


# ---- several summaries from one scan ---------------------------------------------
@dataclass(frozen=True)
class SummaryGroups:
    """The rows of several summaries computed by ONE grouping-sets aggregate.

    ``rows`` holds one row per group of every summary, tagged by ``_gid``
    (Spark's ``grouping_id``); ``layout`` maps each summary name to its
    grouping id, its ``(internal key, output name)`` pairs and its measure names.
    """

    rows: DataFrame
    layout: dict[str, tuple[int, list[tuple[str, str]], list[str]]]

    def with_rows(self, rows: DataFrame) -> "SummaryGroups":
        """The same layout over other rows (e.g. the staged copy read back)."""
        return SummaryGroups(rows, self.layout)

    def long_form(self) -> DataFrame:
        """All groups of all summaries in one frame: ``summary``, every key column
        (by output name; NULL where a summary does not group by it) and every measure."""
        names: dict[int, list[str]] = {}
        keys: dict[str, str] = {}
        measures: list[str] = []
        for name, (gid, key_pairs, m_names) in self.layout.items():
            names.setdefault(gid, []).append(name)
            for k, n in key_pairs:
                keys.setdefault(k, n)
            measures += [m for m in m_names if m not in measures]
        out_names = ["summary", *keys.values(), *measures]
        if len(set(out_names)) != len(out_names):
            raise ValueError(f"long form needs distinct column names, got {out_names}")
        label = F
        for gid, ns in names.items():
            label = label.when(F.col("_gid") == gid, F.lit(",".join(ns)))
        return self.rows.select(
            label.alias("summary"), *[F.col(k).alias(n) for k, n in keys.items()], *measures
        )

    def summary(self, name: str, updated_at: Column | None = None) -> DataFrame:
        """One summary, with the columns and order ``SummarySpec.build`` gives."""
        gid, keys, measures = self.layout[name]
        out = self.rows.filter(F.col("_gid") == gid).select(
            *[F.col(k).alias(n) for k, n in keys], *measures
        )
        if updated_at is not None:
            out = out.withColumn("updated_at", updated_at)
        return out


def summary_groups(df: DataFrame, specs: Sequence[SummarySpec] = GOLD_SUMMARIES) -> SummaryGroups:
    """Every summary of ``specs`` in ONE aggregate over ``df`` (GROUPING SETS).

    Spark plans Expand → partial aggregate → one shuffle → final aggregate:
    ``df`` is scanned once instead of once per summary, and a hot key is
    still collapsed map-side. Each group's sums are computed from the input
    rows (never re-aggregated from another summary), so values equal the
    separate ``groupBy`` results. The output is one row per group — small —
    and is meant to be staged once and split per summary.
    """
    key_exprs: dict[str, tuple[str, Column]] = {}  # expression text → (internal name, column)
    measures: dict[str, Column] = {}
    layout_keys: dict[str, tuple[list[str], list[tuple[str, str]], list[str]]] = {}
    for spec in specs:
        keys = spec.keys()
        names = df.select(*keys).columns  # analysis only: output names of the keys
        internal = []
        for col, name in zip(keys, names):
            text = str(col)
            if text not in key_exprs:
                key_exprs[text] = (f"_k{len(key_exprs)}", col)
            internal.append((key_exprs[text][0], name))
        ms = spec.measures()
        m_names = df.agg(*ms).columns
        for col, name in zip(ms, m_names):
            if name in measures and str(measures[name]) != str(col):
                raise ValueError(f"measure {name!r} means different things in two summaries")
            measures.setdefault(name, col)
        layout_keys[spec.name] = ([k for k, _ in internal], internal, m_names)
    all_keys = [k for k, _ in key_exprs.values()]
    keyed = df.select("*", *[col.alias(k) for k, col in key_exprs.values()])
    sets: list[list[str]] = []
    for key_list, _, _ in layout_keys.values():
        if key_list not in sets:  # a repeated set would emit its groups twice
            sets.append(key_list)
    rows = keyed.groupingSets(sets, *all_keys).agg(
        *measures.values(), F.grouping_id().alias("_gid")
    )
    n = len(all_keys)
    layout = {
        name: (
            sum(1 << (n - 1 - i) for i, k in enumerate(all_keys) if k not in key_list),
            internal,
            m_names,
        )
        for name, (key_list, internal, m_names) in layout_keys.items()
    }
    return SummaryGroups(rows, layout)
