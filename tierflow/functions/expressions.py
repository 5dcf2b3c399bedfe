"""Scalar column expressions (E1–E5). All built-in functions: they stay inside
whole-stage codegen and need no Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def bucketize(
    value: Column | str,
    rules: Sequence[tuple[float, str]],
    otherwise: str,
    strict: bool = True,
    null_label: str | None = None,
) -> Column:
    """Label ``value`` by the first rule whose lower bound it passes.

    ``rules`` are ``(bound, label)`` checked in order (give them descending);
    ``strict`` uses ``>`` instead of ``>=``. With ``null_label`` a NULL
    value gets that label first; without it NULL fails every comparison and
    falls through to ``otherwise``.
    """
    v = _col(value)
    expr = None
    if null_label is not None:
        expr = F.when(v.isNull(), F.lit(null_label))
    for bound, label in rules:
        cond = v > F.lit(bound) if strict else v >= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(otherwise)
    return expr.otherwise(F.lit(otherwise))


# --- fixed values: bucket bounds and labels (must equal the published tables) ---
# Size category on area (km2), strict ">" bounds, NULL area is "Unknown":
SIZE_UNKNOWN = "Unknown"
SIZE_RULES = (
    (1_000_000, "Very Large (>1M km2)"),
    (100_000, "Large (100k-1M km2)"),
    (10_000, "Medium (10k-100k km2)"),
)
SIZE_OTHERWISE = "Small (<10k km2)"
# Population tier, non-strict ">=" bounds, NULL and negatives fall to Micro:
TIER_RULES = (
    (100_000_000, "Large (>=100M)"),
    (10_000_000, "Medium (10M-100M)"),
    (1_000_000, "Small (1M-10M)"),
)
TIER_OTHERWISE = "Micro (<1M)"
# ---------------------------------------------------------------------------------


def size_category(area: Column | str = "area") -> Column:
    """Area bucket; exactly 1,000,000 is Large, exactly 10,000 is Small, NaN is Very Large."""
    return bucketize(area, SIZE_RULES, SIZE_OTHERWISE, strict=True, null_label=SIZE_UNKNOWN)


def population_tier(population: Column | str = "population") -> Column:
    """Population tier; NULL and negative populations are Micro."""
    return bucketize(population, TIER_RULES, TIER_OTHERWISE, strict=False)


def guarded_ratio(
    numerator: Column | str, denominator: Column | str, scale: int | None = 2
) -> Column:
    """``numerator / denominator`` only where ``denominator > 0`` (else NULL), rounded HALF_UP.

    The guard sits inside the CASE, so ANSI division never sees a zero.
    """
    d = _col(denominator)
    ratio = F.when(d > 0, _col(numerator) / d)
    return F.round(ratio, scale) if scale is not None else ratio


def payload_bytes(text: Column | str = "raw_json") -> Column:
    """UTF-8 size of a payload in bytes."""
    return F.octet_length(_col(text))


def human_number(n: Column | str) -> Column:
    """E5: ``2.35B`` / ``12.3M`` / ``4.5K`` / plain digits for smaller numbers.

    Rounding is HALF_UP on the decimal value (``round`` then print), so the
    text is the same on every engine that rounds decimals half-up.
    """
    v = _col(n)
    return (
        F.when(v >= 1_000_000_000, F.format_string("%.2fB", F.round(v / 1_000_000_000, 2)))
        .when(v >= 1_000_000, F.format_string("%.1fM", F.round(v / 1_000_000, 1)))
        .when(v >= 1_000, F.format_string("%.1fK", F.round(v / 1_000, 1)))
        .otherwise(v.cast("string"))
    )


def truncate_to_long(x: Column | str) -> Column:
    """``int(x)`` for display: toward zero."""
    return _col(x).cast("long")
