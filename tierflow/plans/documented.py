"""The six documented gold-layer SQL queries and two further views, over any table names.

Each ORDER BY ends with a unique tie-breaker so the order is deterministic
and a hot sort value can be split across range partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: the documented queries (columns and order keys) ---
DOCUMENTED_SQL: dict[str, str] = {
    "sql_density": (
        "SELECT name_common, cca2, region, population, population_density, size_category "
        "FROM {countries} ORDER BY population_density DESC, cca2"
    ),
    "sql_by_region": (
        "SELECT region, subregion, country_count, total_population, total_area_km2, "
        "un_member_count FROM {countries_by_region} ORDER BY total_population DESC, region, subregion"
    ),
    "sql_by_continent": (
        "SELECT continent, country_count, total_population FROM {countries_by_continent} "
        "ORDER BY total_population DESC, continent"
    ),
    "sql_tiers": (
        "SELECT population_tier, country_count, total_population FROM {population_tiers} "
        "ORDER BY total_population DESC, population_tier"
    ),
    "sql_landlocked": (
        "SELECT region, landlocked, country_count, total_population FROM {landlocked_vs_coastal} "
        "ORDER BY region, landlocked"
    ),
    "sql_un": (
        "SELECT region, un_member, country_count, total_population FROM {un_membership_summary} "
        "ORDER BY region, un_member"
    ),
    "view_region_ranked": (
        "SELECT region, subregion, country_count, total_population, total_area_km2, un_member_count "
        "FROM {countries_by_region} ORDER BY region, total_population DESC, subregion"
    ),
    "view_continent_full": (
        "SELECT continent, country_count, total_population, total_area_km2, un_member_count "
        "FROM {countries_by_continent} ORDER BY total_population DESC, continent"
    ),
}
# ----------------------------------------------------------------------


def documented_query(spark: SparkSession, name: str, tables: dict[str, str]) -> DataFrame:
    """Run one documented query; ``tables`` maps gold table names to catalog/view names."""
    return spark.sql(DOCUMENTED_SQL[name].format(**tables))


def documented_queries(spark: SparkSession, tables: dict[str, str]) -> dict[str, DataFrame]:
    return {name: documented_query(spark, name, tables) for name in DOCUMENTED_SQL}
