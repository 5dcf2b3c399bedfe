"""Data-quality rules, single-pass reports and enforcement (Q3–Q10).

Every rule contributes one aggregate expression; all rules for a table are
evaluated in ONE ``agg`` (one scan, partial+final aggregation) and unpivoted
into a report ``DataFrame[table_name, check, observed, threshold, passed]``.
The report has one row per rule, so enforcing it collects a bounded result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.operators.summaries import distinct_with_null

REPORT_COLUMNS = ("table_name", "check", "observed", "threshold", "passed")


@dataclass(frozen=True)
class Rule:
    """Base rule: ``observed()`` is an aggregate; ``passed(m)`` judges its value."""

    @property
    def check(self) -> str:  # pragma: no cover - overridden
        raise NotImplementedError

    @property
    def threshold(self) -> str:  # pragma: no cover - overridden
        raise NotImplementedError

    def observed(self) -> Column:  # pragma: no cover - overridden
        raise NotImplementedError

    def passed(self, m: Column) -> Column:  # pragma: no cover - overridden
        raise NotImplementedError


@dataclass(frozen=True)
class NonEmpty(Rule):
    """Q3: at least one row."""

    @property
    def check(self) -> str:
        return "non_empty"

    @property
    def threshold(self) -> str:
        return "> 0"

    def observed(self) -> Column:
        return F.count(F.lit(1))

    def passed(self, m: Column) -> Column:
        return m > 0


@dataclass(frozen=True)
class RowCountBetween(Rule):
    """Q4: ``lo <= rows <= hi`` (inclusive)."""

    lo: int
    hi: int

    @property
    def check(self) -> str:
        return "row_count_in_range"

    @property
    def threshold(self) -> str:
        return f"[{self.lo}, {self.hi}]"

    def observed(self) -> Column:
        return F.count(F.lit(1))

    def passed(self, m: Column) -> Column:
        return m.between(self.lo, self.hi)


@dataclass(frozen=True)
class Unique(Rule):
    """Q5: ``rows − distinct keys`` must be 0; NULL is one key value."""

    columns: tuple[str, ...]

    @property
    def check(self) -> str:
        return f"duplicate_keys({','.join(self.columns)})"

    @property
    def threshold(self) -> str:
        return "= 0"

    def observed(self) -> Column:
        if len(self.columns) == 1:
            distinct = distinct_with_null(self.columns[0])
        else:
            # a struct is never NULL, so NULL components count as values
            distinct = F.count_distinct(F.struct(*self.columns))
        return F.count(F.lit(1)) - distinct

    def passed(self, m: Column) -> Column:
        return m == 0


@dataclass(frozen=True)
class NullRateAtMost(Rule):
    """Q6: share of NULLs ``<= max_rate``; an empty table counts as rate 1.0."""

    column: str
    max_rate: float

    @property
    def check(self) -> str:
        return f"null_rate({self.column})"

    @property
    def threshold(self) -> str:
        return f"<= {self.max_rate}"

    def observed(self) -> Column:
        n = F.count(F.lit(1))
        return F.when(n > 0, F.count_if(F.col(self.column).isNull()) / n).otherwise(F.lit(1.0))

    def passed(self, m: Column) -> Column:
        return m <= F.lit(self.max_rate)


@dataclass(frozen=True)
class NoNulls(Rule):
    """Q7: no NULL in the column."""

    column: str

    @property
    def check(self) -> str:
        return f"null_count({self.column})"

    @property
    def threshold(self) -> str:
        return "= 0"

    def observed(self) -> Column:
        return F.count_if(F.col(self.column).isNull())

    def passed(self, m: Column) -> Column:
        return m == 0


@dataclass(frozen=True)
class NoNegatives(Rule):
    """Q8: no value ``< 0`` (zero is valid; NULL is not negative)."""

    column: str

    @property
    def check(self) -> str:
        return f"negative_count({self.column})"

    @property
    def threshold(self) -> str:
        return "= 0"

    def observed(self) -> Column:
        return F.count_if(F.col(self.column) < 0)

    def passed(self, m: Column) -> Column:
        return m == 0


#: Hashes that may stand twice and are still sent to every task (8 bytes each).
FEW_CANDIDATES = 20_000


def duplicate_rows(df: DataFrame, columns: Sequence[str], few: int = FEW_CANDIDATES) -> DataFrame:
    """Q5/A11 for wide keys that are nearly unique: one row ``rows, duplicates`` (rows minus distinct keys).

    ``count(DISTINCT key)`` shuffles every key. Here a 64-bit hash of the key is
    shuffled instead and counted; a key whose hash stands once is unique. Only
    rows whose hash stands twice are compared by their keys, which decides
    (unlike keys may share a hash). Hot keys are counted before each shuffle.

    Runs a job that finds the hashes standing twice: up to ``few`` of them become
    a filter where the rows are read. With more, keys are not nearly unique and
    are counted as they are. NULL is a value.
    """
    keys = [F.col(f"`{c}`") for c in columns]
    hashed = F.xxhash64(*[k for c in keys for k in (c, c.isNull())]).alias("_hash")
    twice = df.select(hashed).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash")
    total = df.agg(F.count(F.lit(1)).alias("rows"))
    found = [r["_hash"] for r in twice.limit(few + 1).collect()]
    if not found:
        return total.select("rows", F.lit(0).cast("long").alias("duplicates"))
    rows = df.select(*[k.alias(f"_k{i}") for i, k in enumerate(keys)], hashed)
    if len(found) <= few:
        rows = rows.filter(F.col("_hash").isin(found))
    counted = rows.groupBy("_hash", *[f"_k{i}" for i in range(len(keys))]).agg(F.count(F.lit(1)).alias("_n"))
    extra = counted.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))
    return total.select("rows", extra.scalar().alias("duplicates"))


def quality_report(df: DataFrame, rules: Sequence[Rule], table_name: str) -> DataFrame:
    """Evaluate ``rules`` over ``df`` in one aggregate and return one report row per rule."""
    if not rules:
        raise ValueError("no rules given")
    metrics = df.agg(*[r.observed().cast("double").alias(f"m{i}") for i, r in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(table_name).alias("table_name"),
            F.lit(r.check).alias("check"),
            F.col(f"m{i}").alias("observed"),
            F.lit(r.threshold).alias("threshold"),
            F.coalesce(r.passed(F.col(f"m{i}")), F.lit(False)).alias("passed"),
        )
        for i, r in enumerate(rules)
    ]
    return metrics.select(F.inline(F.array(*rows)))


def non_empty_report(counts: DataFrame) -> DataFrame:
    """Q3 for many tables from ``DataFrame[table_name, rows]``: each table's row count, passed if > 0."""
    rule = NonEmpty()
    return counts.select(
        "table_name",
        F.lit(rule.check).alias("check"),
        F.col("rows").cast("double").alias("observed"),
        F.lit(rule.threshold).alias("threshold"),
        rule.passed(F.col("rows")).alias("passed"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``DataFrame[table_name, rows]``; a stored table is counted from its file footers, no column is read."""
    if not tables:
        raise ValueError("no tables given")
    return union_reports([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()])


def reconcile_report(
    summary: DataFrame,
    count_column: str,
    detail: DataFrame,
    table_name: str,
) -> DataFrame:
    """Q9: ``sum(summary.count_column)`` must equal ``count(detail)``.

    NULL-safe: an empty summary (sum NULL) fails even against an empty detail.
    The detail count is a scalar sub-query, so no join is planned.
    """
    detail_rows = detail.agg(F.count(F.lit(1))).scalar()
    s = summary.agg(F.sum(count_column).alias("s"))
    return s.select(
        F.lit(table_name).alias("table_name"),
        F.lit(f"reconcile(sum({count_column}))").alias("check"),
        F.col("s").cast("double").alias("observed"),
        F.concat(F.lit("= "), detail_rows.cast("string")).alias("threshold"),
        F.col("s").eqNullSafe(detail_rows).alias("passed"),
    )


def union_reports(reports: Sequence[DataFrame]) -> DataFrame:
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def failures(report: DataFrame) -> list[str]:
    """Failed checks as messages (the report is one row per rule: bounded)."""
    rows = report.filter(~F.col("passed")).collect()
    return [
        f"{r['table_name']}: {r['check']} observed {r['observed']} (expected {r['threshold']})"
        for r in rows
    ]


def enforce(report: DataFrame) -> None:
    """Q10: raise one ``AssertionError`` listing every failed check."""
    failed = failures(report)
    if failed:
        raise AssertionError(f"{len(failed)} data quality check(s) failed: " + "; ".join(failed))
