"""DuckDB oracle SQL for every registered query (same names, same columns).

Written directly on the flat test tables with the adapter's expressions, so
it checks the JSON round trip, the operators and their NULL semantics at once.
DuckDB specifics handled here: ``sum(bigint)`` is HUGEINT (cast back),
decimal rounding is done on the double's decimal text (as Spark does), and
``%.Nf`` is applied to an already-rounded value.
"""

from __future__ import annotations

from tierflow.plans.documented import DOCUMENTED_SQL

_ENT = """ent AS (
  SELECT
    event_id,
    event_type || '-' || CAST(event_id AS VARCHAR) AS name_common,
    upper(event_type || '-' || CAST(event_id AS VARCHAR)) AS name_official,
    CASE WHEN event_id % 97 <> 0 THEN CAST(event_id AS VARCHAR) END AS cca2,
    'E' || CAST(event_id AS VARCHAR) AS cca3,
    CASE WHEN event_id % 50 <> 0 THEN event_type END AS region,
    'u' || CAST(user_id % 7 AS VARCHAR) AS subregion,
    CASE WHEN event_id % 83 <> 0 THEN CAST(round(value * 100) AS BIGINT) * 10000 END AS population,
    CASE WHEN event_id % 40 <> 0 THEN user_id * 10000 END AS area_whole,
    CASE WHEN event_id % 31 <> 0 THEN user_id % 3 = 0 END AS landlocked,
    event_type <> 'error' AS un_member,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS batch_id,
    CAST(CAST(ts AS DATE) AS TIMESTAMP) AS ingested_at
  FROM events)"""

_BRONZE = """bronze AS (
  SELECT
    CAST(to_json({'name': {'common': name_common, 'official': name_official},
      'cca2': cca2, 'cca3': cca3, 'region': region, 'subregion': subregion,
      'population': population, 'area': area_whole, 'landlocked': landlocked,
      'unMember': un_member}) AS VARCHAR) AS raw_json,
    'table:events' AS source_url, batch_id, ingested_at
  FROM ent)"""

_SILVER_COLS = """name_common, name_official, cca2, cca3, region, subregion, population,
    CAST(area_whole AS DOUBLE) AS area, landlocked, un_member, ingested_at AS source_ingested_at"""

_SILVER = f"""silver AS (
  SELECT {_SILVER_COLS}
  FROM ent WHERE cca2 IS NOT NULL)"""

_NEWEST = "(SELECT max(ingested_at) FROM ent)"


def _round_dec(x: str, n: int) -> str:
    """Spark's ROUND on a double: HALF_UP on its decimal text."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,10)), {n}) AS DOUBLE)"


_SIZE = """CASE WHEN area IS NULL THEN 'Unknown'
      WHEN area > 1000000 THEN 'Very Large (>1M km2)'
      WHEN area > 100000 THEN 'Large (100k-1M km2)'
      WHEN area > 10000 THEN 'Medium (10k-100k km2)'
      ELSE 'Small (<10k km2)' END"""

_TIER = """CASE WHEN population >= 100000000 THEN 'Large (>=100M)'
      WHEN population >= 10000000 THEN 'Medium (10M-100M)'
      WHEN population >= 1000000 THEN 'Small (1M-10M)'
      ELSE 'Micro (<1M)' END"""

_GOLD = f"""gold AS (
  SELECT name_common, name_official, cca2, cca3, region, subregion, population, area,
    CASE WHEN area > 0 THEN {_round_dec('population / area', 2)} END AS population_density,
    {_SIZE} AS size_category,
    landlocked, un_member, source_ingested_at
  FROM silver)"""

_WITH = f"WITH {_ENT},\n{_BRONZE},\n{_SILVER},\n{_GOLD}"

_SUMMARIES = {
    "countries_by_region": """SELECT region, subregion, count(*) AS country_count,
    CAST(sum(population) AS BIGINT) AS total_population, sum(area) AS total_area_km2,
    CAST(sum(CAST(un_member AS INTEGER)) AS BIGINT) AS un_member_count,
    max(source_ingested_at) AS source_ingested_at
  FROM silver GROUP BY region, subregion""",
    "countries_by_continent": """SELECT region AS continent, count(*) AS country_count,
    CAST(sum(population) AS BIGINT) AS total_population, sum(area) AS total_area_km2,
    CAST(sum(CAST(un_member AS INTEGER)) AS BIGINT) AS un_member_count,
    max(source_ingested_at) AS source_ingested_at
  FROM silver GROUP BY region""",
    "population_tiers": f"""SELECT {_TIER} AS population_tier, count(*) AS country_count,
    CAST(sum(population) AS BIGINT) AS total_population,
    max(source_ingested_at) AS source_ingested_at
  FROM silver GROUP BY 1""",
    "landlocked_vs_coastal": """SELECT region, landlocked, count(*) AS country_count,
    CAST(sum(population) AS BIGINT) AS total_population, sum(area) AS total_area_km2,
    max(source_ingested_at) AS source_ingested_at
  FROM silver GROUP BY region, landlocked""",
    "un_membership_summary": """SELECT region, un_member, count(*) AS country_count,
    CAST(sum(population) AS BIGINT) AS total_population,
    max(source_ingested_at) AS source_ingested_at
  FROM silver GROUP BY region, un_member""",
}


_ALL_MEASURES = """count(*) AS country_count,
    CAST(sum(population) AS BIGINT) AS total_population, sum(area) AS total_area_km2,
    CAST(sum(CAST(un_member AS INTEGER)) AS BIGINT) AS un_member_count,
    max(source_ingested_at) AS source_ingested_at"""

# (summary, region, subregion, continent, population_tier, landlocked, un_member, GROUP BY)
_GROUP_SETS = [
    ("countries_by_region", "region", "subregion", "NULL", "NULL", "NULL", "NULL", "region, subregion"),
    ("countries_by_continent", "NULL", "NULL", "region", "NULL", "NULL", "NULL", "region"),
    ("population_tiers", "NULL", "NULL", "NULL", _TIER, "NULL", "NULL", "5"),
    ("landlocked_vs_coastal", "region", "NULL", "NULL", "NULL", "landlocked", "NULL", "region, landlocked"),
    ("un_membership_summary", "region", "NULL", "NULL", "NULL", "NULL", "un_member", "region, un_member"),
]


def _summary_groups() -> str:
    parts = [
        f"""SELECT '{name}' AS summary, CAST({r} AS VARCHAR) AS region, CAST({sr} AS VARCHAR) AS subregion,
    CAST({c} AS VARCHAR) AS continent, CAST({t} AS VARCHAR) AS population_tier,
    CAST({ll} AS BOOLEAN) AS landlocked, CAST({un} AS BOOLEAN) AS un_member, {_ALL_MEASURES}
  FROM silver GROUP BY {g}"""
        for name, r, sr, c, t, ll, un, g in _GROUP_SETS
    ]
    return f"{_WITH}\n" + "\nUNION ALL\n".join(parts)


def _human(x: str) -> str:
    return f"""CASE WHEN {x} >= 1000000000 THEN printf('%.2fB', {_round_dec(f'{x} / 1000000000', 2)})
      WHEN {x} >= 1000000 THEN printf('%.1fM', {_round_dec(f'{x} / 1000000', 1)})
      WHEN {x} >= 1000 THEN printf('%.1fK', {_round_dec(f'{x} / 1000', 1)})
      ELSE CAST({x} AS VARCHAR) END"""


def _report_row(table: str, check: str, observed: str, threshold: str, passed: str, src: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS \"check\", CAST({observed} AS DOUBLE) AS observed, "
        f"'{threshold}' AS threshold, COALESCE({passed}, false) AS passed FROM {src}"
    )


def _dq(table: str, src: str, rules: list[tuple[str, str, str, str]]) -> str:
    """rules: (check, observed aggregate, threshold text, passed on ``m``)."""
    parts = []
    for check, observed, threshold, passed in rules:
        parts.append(
            f"SELECT '{table}' AS table_name, '{check}' AS \"check\", m AS observed, "
            f"'{threshold}' AS threshold, COALESCE({passed}, false) AS passed "
            f"FROM (SELECT CAST({observed} AS DOUBLE) AS m FROM {src})"
        )
    return "\nUNION ALL\n".join(parts)


def _distinct_with_null(c: str) -> str:
    return f"(count(DISTINCT {c}) + COALESCE(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0))"


def _null_rate(c: str) -> str:
    return f"CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE {c} IS NULL) / count(*) ELSE 1.0 END"


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    o["land_raw"] = f"{_WITH}\nSELECT raw_json, source_url, batch_id, ingested_at FROM bronze"
    # what each event's document holds, from the adapter's rule alone
    o["explode_documents"] = """WITH d AS (SELECT event_id, event_id % 11 <> 0 AS ok, event_id % 4 AS n FROM events),
x AS (SELECT *, unnest(CASE WHEN ok AND n > 0 THEN range(n) ELSE [NULL] END) AS i FROM d)
SELECT CAST(event_id AS VARCHAR) AS path, ok AS doc_is_array, CAST(CASE WHEN ok THEN n ELSE -1 END AS INTEGER) AS doc_size,
  CASE WHEN i IS NULL THEN NULL WHEN (event_id + i) % 5 = 0 THEN 'null' ELSE '{"id":' || event_id || ',"i":' || i || '}' END AS raw_json
FROM x"""
    o["sorted_runs"] = "SELECT event_type, CAST(ts AS DATE) AS day FROM events ORDER BY day, event_type"
    o["land_large_array"] = r"""WITH e AS (SELECT event_id, event_id // 25000 AS doc,
  '{"id":' || event_id || ',"kind":"' || event_type || '","note":"'
  || CASE event_id % 5 WHEN 1 THEN '}],[{' WHEN 2 THEN '\"}' WHEN 3 THEN 'a\\' ELSE '' END
  || '","in":{"n":[' || event_id || ',{"m":"}"}]}}' AS rec FROM events),
x AS (SELECT doc, unnest(CASE WHEN event_id % 13 = 0 THEN [rec, 'null'] ELSE [rec] END) AS raw_json FROM e)
SELECT doc, true AS doc_is_array, CAST(count(*) OVER (PARTITION BY doc) AS INTEGER) AS doc_size, raw_json FROM x"""
    o["latest_batch"] = (
        f"{_WITH}\nSELECT raw_json, source_url, batch_id, ingested_at FROM bronze "
        f"WHERE ingested_at = {_NEWEST}"
    )
    o["latest_batch_meta"] = (
        f"{_WITH}\nSELECT batch_id, ingested_at, source_url FROM bronze "
        "ORDER BY ingested_at DESC NULLS LAST, batch_id LIMIT 1"
    )
    o["batch_inventory"] = (
        f"{_WITH}\nSELECT batch_id, ingested_at, count(*) AS row_count FROM bronze "
        "GROUP BY batch_id, ingested_at"
    )
    o["payload_sample"] = (
        f"{_WITH}\nSELECT ingested_at, batch_id, CAST(octet_length(encode(raw_json)) AS INTEGER) AS payload_bytes, raw_json "
        "FROM bronze ORDER BY ingested_at DESC NULLS LAST, raw_json LIMIT 5"
    )
    # the log-based forms must equal the plain ones; the log itself is a GROUP BY
    o["batch_log"] = f"""{_WITH}
SELECT b.batch_id, b.ingested_at, b.source_url, b.record_count, 'cca2' AS keyed_by, e.keyed_count
FROM (SELECT batch_id, max(ingested_at) AS ingested_at, max(source_url) AS source_url,
        count(*) AS record_count FROM bronze GROUP BY batch_id) b
JOIN (SELECT batch_id, count(cca2) AS keyed_count FROM ent GROUP BY batch_id) e USING (batch_id)"""
    o["latest_batch_logged"] = o["latest_batch"]
    o["payload_sample_logged"] = o["payload_sample"]
    o["batch_inventory_logged"] = o["batch_inventory"]
    o["parse_json"] = (
        f"{_WITH}\nSELECT {_SILVER_COLS} FROM ent "
        f"WHERE cca2 IS NOT NULL AND ingested_at = {_NEWEST}"
    )
    o["drop_rate"] = f"""{_WITH}
SELECT total_rows, kept_rows, total_rows - kept_rows AS dropped_rows,
  CASE WHEN total_rows > 0 THEN (total_rows - kept_rows) / total_rows END AS drop_fraction,
  0.02::DOUBLE AS max_drop_fraction,
  (total_rows = 0 OR (total_rows - kept_rows) / total_rows <= 0.02) AS passed
FROM (SELECT count(*) AS total_rows, count(cca2) AS kept_rows FROM ent WHERE ingested_at = {_NEWEST})"""
    o["drop_rate_logged"] = o["drop_rate"]
    # a record that cannot be read has no key; a mistyped field is NULL; text after a record is ignored
    lost = "event_id % 20 IN (1, 4, 5)"
    fields = _SILVER_COLS.replace("population,", "CASE WHEN event_id % 20 <> 3 THEN population END AS population,").replace(" landlocked,", " CASE WHEN event_id % 20 <> 6 THEN landlocked END AS landlocked,")
    o["parse_damaged"] = f"{_WITH}\nSELECT {fields} FROM ent WHERE cca2 IS NOT NULL AND NOT ({lost})"
    o["drop_rate_damaged"] = f"""{_WITH}
SELECT total_rows, kept_rows, total_rows - kept_rows AS dropped_rows,
  CASE WHEN total_rows > 0 THEN (total_rows - kept_rows) / total_rows END AS drop_fraction,
  0.02::DOUBLE AS max_drop_fraction,
  (total_rows = 0 OR (total_rows - kept_rows) / total_rows <= 0.02) AS passed
FROM (SELECT count(*) AS total_rows, count(CASE WHEN NOT ({lost}) THEN cca2 END) AS kept_rows FROM ent)"""
    # a NULL field's key is left out of the payload; no other key is
    nullable = ["area_whole", "cca2", "landlocked", "population", "region"]
    o["contract_violations"] = f"""{_WITH}
SELECT batch_id, count(*) AS row_count,
  count(*) FILTER (WHERE {" OR ".join(f"{c} IS NULL" for c in nullable)}) AS violating_rows,
  CAST({" + ".join(f"max(({c} IS NULL)::INT)" for c in nullable)} AS INTEGER) AS missing_key_count
FROM ent GROUP BY batch_id"""
    o["enrich"] = f"{_WITH}\nSELECT * FROM gold"
    o["sorted_entities"] = f"{_WITH}\nSELECT * FROM silver ORDER BY name_common NULLS FIRST, cca2 NULLS FIRST"
    o["top_n"] = f"""{_WITH}
SELECT name_common, cca2, region, population, area, population_density, size_category, landlocked, un_member
FROM gold ORDER BY population DESC NULLS LAST, name_common LIMIT 20"""
    o["human_numbers"] = f"""{_WITH}
SELECT cca2, name_common,
  {_human('population')} AS population_text,
  {_human('CAST(trunc(area) AS BIGINT)')} AS area_text,
  {_human('CAST(trunc(population_density) AS BIGINT)')} AS density_text
FROM gold"""
    for key, table in (
        ("by_two_keys", "countries_by_region"),
        ("by_one_key", "countries_by_continent"),
        ("tiers", "population_tiers"),
        ("by_key_flag", "landlocked_vs_coastal"),
        ("by_key_flag2", "un_membership_summary"),
    ):
        o[key] = f"{_WITH}\n{_SUMMARIES[table]}"
    o["count_per_key"] = f"{_WITH}\nSELECT region, count(*) AS country_count FROM silver GROUP BY region"
    o["summary_groups"] = _summary_groups()
    gold_ctes = ",\n".join(f"tf_gold_{name} AS ({sql})" for name, sql in _SUMMARIES.items())
    views = {"countries": "gold"} | {name: f"tf_gold_{name}" for name in _SUMMARIES}
    for name, sql in DOCUMENTED_SQL.items():
        o[name] = f"{_WITH},\n{gold_ctes}\n{sql.format(**views)}"
    o["kpi_at_a_glance"] = f"""{_WITH}
SELECT count(*) AS total_countries, {_distinct_with_null('region')} AS regions,
  count(*) FILTER (WHERE un_member) AS un_members, count(*) FILTER (WHERE landlocked) AS landlocked
FROM silver"""
    ext = """SELECT (SELECT count(*) FROM gold) AS total_countries,
  (SELECT CAST(sum(population) AS BIGINT) FROM gold) AS total_population,
  (SELECT count(*) FROM (SELECT region FROM silver GROUP BY region)) AS num_continents,
  (SELECT name_common FROM gold WHERE area IS NOT NULL ORDER BY area DESC, name_common DESC LIMIT 1) AS largest_name,
  (SELECT area FROM gold WHERE area IS NOT NULL ORDER BY area DESC, name_common DESC LIMIT 1) AS largest_area,
  (SELECT name_common FROM gold WHERE population IS NOT NULL ORDER BY population DESC, name_common DESC LIMIT 1) AS most_populous_name,
  (SELECT population FROM gold WHERE population IS NOT NULL ORDER BY population DESC, name_common DESC LIMIT 1) AS most_populous_population,
  (SELECT name_common FROM gold WHERE population_density IS NOT NULL ORDER BY population_density DESC, name_common DESC LIMIT 1) AS densest_name,
  (SELECT population_density FROM gold WHERE population_density IS NOT NULL ORDER BY population_density DESC, name_common DESC LIMIT 1) AS densest_density"""
    o["kpi_extremes"] = f"{_WITH}\n{ext}"
    o["kpi_cards"] = f"""{_WITH},
ext AS ({ext})
SELECT CAST(total_countries AS VARCHAR) AS total_countries,
  {_human('total_population')} AS world_population,
  CAST(num_continents AS VARCHAR) AS continents,
  largest_name,
  {_human('CAST(trunc(largest_area) AS BIGINT)')} AS largest_area,
  most_populous_name,
  {_human('most_populous_population')} AS most_populous_population,
  densest_name,
  {_human('CAST(trunc(densest_density) AS BIGINT)')} AS densest_density
FROM ext"""
    layers = [("bronze.countries_raw", "bronze"), ("silver.countries", "silver"), ("gold.countries", "gold")]
    layers += [(f"gold.{name}", f"tf_gold_{name}") for name in _SUMMARIES]
    o["dq_nonempty"] = f"{_WITH},\n{gold_ctes}\n" + "\nUNION ALL\n".join(
        _dq(t, src, [("non_empty", "count(*)", "> 0", "m > 0")]) for t, src in layers
    )
    o["dq_report"] = f"{_WITH}\n" + _dq(
        "silver.countries",
        "silver",
        [
            ("non_empty", "count(*)", "> 0", "m > 0"),
            ("row_count_in_range", "count(*)", "[220, 260]", "m BETWEEN 220 AND 260"),
            ("duplicate_keys(cca2)", f"count(*) - {_distinct_with_null('cca2')}", "= 0", "m = 0"),
            ("null_rate(region)", _null_rate("region"), "<= 0.05", "m <= 0.05"),
            ("null_count(population)", "count(*) FILTER (WHERE population IS NULL)", "= 0", "m = 0"),
            ("negative_count(population)", "count(*) FILTER (WHERE population < 0)", "= 0", "m = 0"),
        ],
    )
    o["dq_reconcile"] = f"""{_WITH},
{gold_ctes}
SELECT 'gold.countries_by_region' AS table_name, 'reconcile(sum(country_count))' AS "check",
  CAST(s AS DOUBLE) AS observed, '= ' || CAST(d AS VARCHAR) AS threshold,
  COALESCE(s = d, false) AS passed
FROM (SELECT (SELECT sum(country_count) FROM tf_gold_countries_by_region) AS s,
             (SELECT count(*) FROM silver) AS d)"""
    stamp = "TIMESTAMP '2024-05-06 08:00:00'"
    o["job_summaries"] = f"""{_WITH}
SELECT region, subregion, count(*) AS country_count, CAST(sum(population) AS BIGINT) AS total_population, sum(area) AS total_area_km2,
  CAST(sum(CAST(un_member AS INTEGER)) AS BIGINT) AS un_member_count, {stamp} AS source_ingested_at, {stamp} AS updated_at
FROM silver GROUP BY region, subregion"""
    # the jobs' report: the three reports above in one, each table's rows counted once
    rest = "\nUNION ALL\n".join(_dq(t, src, [("non_empty", "count(*)", "> 0", "m > 0")]) for t, src in layers if src != "silver")
    rules, whole = (o[name].split("\n", n)[-1] for name, n in (("dq_report", _WITH.count("\n") + 1), ("dq_reconcile", f"{_WITH},\n{gold_ctes}".count("\n") + 1)))
    o["job_report"] = f"{_WITH},\n{gold_ctes}\n{rest}\nUNION ALL\n{rules}\nUNION ALL\n{whole}"
    o["compacted_log"] = f"""SELECT 'b' || (event_id % 3) AS batch_id, {stamp} AS ingested_at, 'table:events' AS source_url,
  count(*) AS record_count, count(*) AS landed
FROM events GROUP BY 1"""
    o["evolved_batches"] = """SELECT event_id AS id, event_type AS kind, CASE WHEN event_id % 3 = 1 THEN user_id END AS who,
  CASE WHEN event_id % 3 = 2 THEN user_id END AS n, 'b' || (event_id % 3) AS batch_id FROM events"""
    o["published_versions"] = """SELECT 'days' AS name, CAST(CAST(ts AS DATE) AS VARCHAR) AS key, count(*) AS events FROM events GROUP BY 2
UNION ALL SELECT 'kinds', event_type, count(*) FROM events GROUP BY 2"""
    o["lineitem_summary"] = """SELECT l_returnflag, l_linestatus, count(*) AS row_count,
  round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
  max(l_shipdate) AS max_shipdate
FROM lineitem GROUP BY l_returnflag, l_linestatus"""
    o["duplicate_rows"] = """SELECT 'lineitem' AS table_name, 2 AS columns, count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicates FROM lineitem
UNION ALL SELECT 'lineitem', 3, count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey, l_shipdate FROM lineitem)) FROM lineitem
UNION ALL SELECT 'orders', CAST((SELECT count(*) FROM (DESCRIBE orders)) AS INTEGER), count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) FROM orders"""
    o["orders_dq"] = _dq(
        "orders",
        "orders",
        [
            ("non_empty", "count(*)", "> 0", "m > 0"),
            ("duplicate_keys(o_orderkey)", f"count(*) - {_distinct_with_null('o_orderkey')}", "= 0", "m = 0"),
            ("null_rate(o_orderpriority)", _null_rate("o_orderpriority"), "<= 0.05", "m <= 0.05"),
            ("null_count(o_custkey)", "count(*) FILTER (WHERE o_custkey IS NULL)", "= 0", "m = 0"),
            ("negative_count(o_totalprice)", "count(*) FILTER (WHERE o_totalprice < 0)", "= 0", "m = 0"),
        ],
    )
    o["lineitem_dq"] = _dq(
        "lineitem",
        "lineitem",
        [
            ("non_empty", "count(*)", "> 0", "m > 0"),
            (
                "duplicate_keys(l_orderkey,l_linenumber)",
                "count(*) - count(DISTINCT (l_orderkey, l_linenumber))",
                "= 0",
                "m = 0",
            ),
            ("null_rate(l_shipdate)", _null_rate("l_shipdate"), "<= 0.05", "m <= 0.05"),
            ("null_count(l_partkey)", "count(*) FILTER (WHERE l_partkey IS NULL)", "= 0", "m = 0"),
            ("negative_count(l_quantity)", "count(*) FILTER (WHERE l_quantity < 0)", "= 0", "m = 0"),
            ("negative_count(l_discount)", "count(*) FILTER (WHERE l_discount < 0)", "= 0", "m = 0"),
        ],
    )
    return o
