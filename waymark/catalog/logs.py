"""Sources, filters, dimensions, deduplication and samples over the search logs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.catalog.pieces import (
    DECODED, DEVELOPER, FIXTURE_KEYS, KEY_ORDER, KEYS, chosen_sql, counted_sql, finished_sql, hash_of, time_sql, time_text,
)
from waymark.catalog.registry import query
from waymark.fixtures import NOW, read_table, view
from waymark.functions.text import pipe_items
from waymark.operators import filters as f
from waymark.operators.backfill import window_edges
from waymark.operators.dedup import COUNT, dedup_count
from waymark.operators.dimensions import (
    country_to_iso2, decode_fields, decode_fields_join, in_countries, match_countries, spelling_pairs, spelling_sets,
)
from waymark.operators.ordering import row_index
from waymark.operators.ranking import first_n, random_sample
from waymark.plans.sampling import backfill_logs, country_count, ranked_sample, sample_logs, sample_name
from waymark.schemas import SAMPLE_COLUMNS
from waymark.session import new_path
from waymark.sources.sinks import write_country_samples, write_log_by_day
from waymark.sources.tables import read_by_format, scan_logs

LOGS = ["search_logs"]
SAMPLER_VIEWS = ["search_logs", "country_spellings", "populated_fields_master"]
SAMPLE_SIZE = 10


def _logs(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "search_logs")


def _spellings(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "country_spellings")


def _fields(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "populated_fields_master")


SCANNED = "log_id, request_uri, method_name, developer_email"
SEEN_SQL = time_sql("client_received_start_timestamp", "seen")


@query("scan_logs", LOGS, f"SELECT {SCANNED}, {SEEN_SQL} FROM search_logs")
def _scan(spark: SparkSession, sf: str) -> DataFrame:
    _logs(spark, sf).createOrReplaceTempView("waymark_scanned_logs")
    return scan_logs(spark, "waymark_scanned_logs").select(*SCANNED.split(", "), time_text(f.TIMESTAMP, "seen"))


@query("read_by_format", LOGS, f"""
SELECT log_id, file_format, {KEYS} FROM search_logs, (SELECT unnest(['csv', 'parquet']) AS file_format)""")
def _formats(spark: SparkSession, sf: str) -> DataFrame:
    logs = _logs(spark, sf).select("log_id", *FIXTURE_KEYS)
    saved = {kind: f"{new_path(spark, 'logs')}.{kind}" for kind in ("csv", "parquet")}
    logs.write.parquet(saved["parquet"])
    logs.write.options(sep=";", header=True, escape='"').csv(saved["csv"])
    parts = [
        read_by_format(spark, path, schema=logs.schema).withColumn("file_format", F.lit(kind)) for kind, path in saved.items()
    ]
    return parts[0].unionByName(parts[1])


@query("sample_sink_roundtrip", SAMPLER_VIEWS, f"""
SELECT request_uri, searched_query, populated_fields, countryName, who_searched, request_country, method_name,
  lib_postal_result, parsed_request_quertystring, developer_email, search_query_counts, country, components,
  number_components FROM finished""", {
    "chosen": chosen_sql(20), "counted": counted_sql("chosen"), "decoded": DECODED,
    "ranked": f"SELECT *, row_number() OVER (PARTITION BY country ORDER BY {KEY_ORDER}) AS rn FROM counted",
    "cut": f"SELECT * FROM ranked WHERE rn <= {SAMPLE_SIZE}", "finished": finished_sql("cut"),
})
def _sink(spark: SparkSession, sf: str) -> DataFrame:
    sample = _sampler(spark, sf)
    path = write_country_samples(sample, new_path(spark, "samples"), "csv", name=sample_name(True, dt.date(2024, 1, 31)))
    return read_by_format(spark, path, schema=sample.select(*SAMPLE_COLUMNS).schema, file_format="csv")


@query("filter_lookback", LOGS, f"""
SELECT log_id, {SEEN_SQL} FROM search_logs
WHERE client_received_start_timestamp > TIMESTAMP '{NOW}' - INTERVAL 20 DAY""")
def _lookback(spark: SparkSession, sf: str) -> DataFrame:
    return _logs(spark, sf).where(f.looked_back(NOW, "20")).select("log_id", time_text(f.TIMESTAMP, "seen"))


@query("filter_date_range", LOGS, f"""
SELECT log_id, {SEEN_SQL} FROM search_logs
WHERE client_received_start_timestamp >= TIMESTAMP '{NOW}' - INTERVAL 25 DAY
  AND client_received_start_timestamp < TIMESTAMP '{NOW}' - INTERVAL 10 DAY""")
def _date_range(spark: SparkSession, sf: str) -> DataFrame:
    return _logs(spark, sf).where(f.in_date_range(NOW, 25, 10)).select("log_id", time_text(f.TIMESTAMP, "seen"))


def _by_day(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "log-by-day")
    write_log_by_day(_logs(spark, sf), path)
    return scan_logs(spark, path=path)


@query("log_by_day", LOGS, f"""
SELECT log_id, {KEYS}, {SEEN_SQL} FROM search_logs WHERE lower(countryName) IN ('nation_3', 'nation_11')
  AND client_received_start_timestamp >= TIMESTAMP '{NOW}' - INTERVAL 12 DAY AND client_received_start_timestamp < TIMESTAMP '{NOW}' - INTERVAL 5 DAY""")
def _days(spark: SparkSession, sf: str) -> DataFrame:
    kept = _by_day(spark, sf).where(f.on_days(NOW, 12, 5) & f.country_named(["Nation_3", "NATION_11"]))
    return kept.select("log_id", *FIXTURE_KEYS, time_text(f.TIMESTAMP, "seen"))


@query("filter_full_address", LOGS, "SELECT log_id, who_searched FROM search_logs WHERE who_searched = 'Full Address Search'")
def _full(spark: SparkSession, sf: str) -> DataFrame:
    return _logs(spark, sf).where(f.full_addresses()).select("log_id", "who_searched")


@query("filter_country", ["search_logs", "country_spellings"], """
SELECT log_id, countryName FROM search_logs
WHERE lower(countryName) IN (SELECT lower(spelling) FROM country_spellings WHERE country_code IN ('N1', 'N4', 'N9'))""")
def _country(spark: SparkSession, sf: str) -> DataFrame:
    return in_countries(_logs(spark, sf), _spellings(spark, sf), ["N1", "N4", "N9"]).select("log_id", "countryName")


@query("filter_endpoint_in", LOGS, """
SELECT log_id, method_name FROM search_logs WHERE lower(method_name) IN ('search 2 search', 'search 2 poisearch')""")
def _endpoint(spark: SparkSession, sf: str) -> DataFrame:
    kept = f.named("method_name", ["search 2 search", "SEARCH 2 poiSearch"])
    return _logs(spark, sf).where(kept).select("log_id", "method_name")


@query("filter_endpoint_not_in", LOGS, """
SELECT log_id, method_name FROM search_logs WHERE lower(method_name) <> 'search 2 poisearch'""")
def _endpoint_out(spark: SparkSession, sf: str) -> DataFrame:
    return _logs(spark, sf).where(f.not_named("method_name", "search 2 poiSearch")).select("log_id", "method_name")


@query("filter_developer", LOGS, f"""
SELECT log_id, developer_email FROM search_logs WHERE coalesce(lower(developer_email), '') NOT IN ('{DEVELOPER}', 'u3@example.com')""")
def _developer(spark: SparkSession, sf: str) -> DataFrame:
    kept = f.not_named("developer_email", (DEVELOPER, "U3@example.com"))
    return _logs(spark, sf).where(kept).select("log_id", "developer_email")


@query("filter_populated_fields", LOGS, """
SELECT log_id, populated_fields FROM search_logs WHERE populated_fields IN ('4|5|6', '|4|5|')""")
def _populated(spark: SparkSession, sf: str) -> DataFrame:
    return _logs(spark, sf).where(f.with_populated_fields(["4|5|6", "|4|5|"])).select("log_id", "populated_fields")


@query("filter_bad_unicode", LOGS, "SELECT log_id, searched_query FROM search_logs WHERE searched_query NOT LIKE '%�%'")
def _unicode(spark: SparkSession, sf: str) -> DataFrame:
    return _logs(spark, sf).where(f.readable()).select("log_id", "searched_query")


@query("filter_not_nearby", LOGS, "SELECT log_id, method_name FROM search_logs WHERE method_name <> 'search 2 nearbySearch'")
def _nearby(spark: SparkSession, sf: str) -> DataFrame:
    return _logs(spark, sf).where(f.not_nearby()).select("log_id", "method_name")


@query("country_match", ["search_logs", "country_spellings"], """
SELECT l.log_id, l.countryName, s.country_code AS country FROM search_logs l
JOIN (SELECT DISTINCT country_code, lower(spelling) AS sp FROM country_spellings) s ON lower(l.countryName) = s.sp""")
def _match(spark: SparkSession, sf: str) -> DataFrame:
    return match_countries(_logs(spark, sf), _spellings(spark, sf)).select("log_id", "countryName", "country")


@query("country_to_iso2", ["search_logs", "country_spellings"], """
SELECT log_id, name, coalesce(code, 'not found') AS iso2
FROM (SELECT log_id, CASE WHEN log_id % 10 = 0 THEN 'Atlantis' ELSE countryName END AS name FROM search_logs) l
LEFT JOIN (SELECT lower(spelling) AS sp, min(country_code) AS code FROM country_spellings GROUP BY 1) s ON lower(l.name) = s.sp""")
def _iso2(spark: SparkSession, sf: str) -> DataFrame:
    name = F.when(F.col("log_id") % 10 == 0, "Atlantis").otherwise(F.col("countryName"))
    return country_to_iso2(_logs(spark, sf).select("log_id", name.alias("name")), _spellings(spark, sf), "name")


DECODE_BODY = """
SELECT log_id, populated_fields, d.components, d.number_components
FROM search_logs l JOIN decoded d ON l.populated_fields = d.pf"""
DECODE_COLUMNS = ["log_id", "populated_fields", "components", "number_components"]


@query("decode_fields", ["search_logs", "populated_fields_master"], DECODE_BODY, {"decoded": DECODED})
def _decode(spark: SparkSession, sf: str) -> DataFrame:
    return decode_fields(_logs(spark, sf), _fields(spark, sf)).select(*DECODE_COLUMNS)


@query("decode_fields_join", ["search_logs", "populated_fields_master"], DECODE_BODY, {"decoded": DECODED})
def _decode_join(spark: SparkSession, sf: str) -> DataFrame:
    logs = _logs(spark, sf).select("log_id", "populated_fields")
    return decode_fields_join(logs, _fields(spark, sf), spread_by=["log_id"]).select(*DECODE_COLUMNS)


@query("pipe_list_size", LOGS, """
SELECT log_id, CAST(len(items) AS INTEGER) AS n_items, array_to_string(items, ',') AS items
FROM (SELECT log_id, list_filter(string_split(populated_fields, '|'), lambda x : x <> '') AS items FROM search_logs)""")
def _pipe(spark: SparkSession, sf: str) -> DataFrame:
    items = pipe_items(F.col("populated_fields"))
    return _logs(spark, sf).select("log_id", F.size(items).alias("n_items"), F.array_join(items, ",").alias("items"))


NAMES = """
SELECT request_country AS country_code, CASE WHEN log_id % 3 = 0 THEN 'eng' ELSE 'en' END AS language, countryName AS name
FROM search_logs"""
CODES = """
SELECT concat('N', CAST(n_nationkey AS STRING)) AS country_code, concat('NT', CAST(n_nationkey AS STRING)) AS iso3,
  CASE WHEN n_nationkey % 2 = 0 THEN concat('Official ', n_name) END AS official_name FROM nation"""


@query("spelling_sets", ["search_logs"], """
SELECT country_code, string_agg(spelling, '|' ORDER BY spelling) AS spellings FROM (
  SELECT country_code, name AS spelling FROM names WHERE length(language) = 2
  UNION SELECT country_code, upper(country_code) FROM codes UNION SELECT country_code, iso3 FROM codes
  UNION SELECT country_code, official_name FROM codes WHERE official_name IS NOT NULL) GROUP BY country_code""",
       {"names": NAMES, "codes": CODES})
def _sets(spark: SparkSession, sf: str) -> DataFrame:
    sets = spelling_sets(*[spark.sql(text, search_logs=_logs(spark, sf), nation=read_table(spark, sf, "nation")) for text in (
        NAMES.replace("FROM search_logs", "FROM {search_logs}"), CODES.replace("FROM nation", "FROM {nation}"))])
    return sets.select("country_code", F.array_join("spellings", "|").alias("spellings"))


@query("spelling_distinct", ["search_logs"], "SELECT DISTINCT request_country AS country_code, countryName AS spelling FROM search_logs")
def _distinct(spark: SparkSession, sf: str) -> DataFrame:
    seen = _logs(spark, sf).select(F.col("request_country").alias("country_code"), F.col("countryName").alias("spelling"))
    return spelling_pairs(seen)


@query("dedup_count", LOGS, f"SELECT {KEYS}, count(*) AS search_query_counts FROM search_logs GROUP BY {KEYS}")
def _dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_count(_logs(spark, sf))


@query("topk_per_country", ["search_logs", "country_spellings"], f"""
SELECT country, {KEYS}, search_query_counts
FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY {KEY_ORDER}) AS rn FROM counted) WHERE rn <= 5""", {
    "chosen": chosen_sql(None, None, full=False), "counted": counted_sql("chosen"),
})
def _topk(spark: SparkSession, sf: str) -> DataFrame:
    logs = _logs(spark, sf).where(f.not_named("method_name", "search 2 poiSearch"))
    spellings = _spellings(spark, sf)
    counted = dedup_count(match_countries(logs, spellings), ["country"])
    return first_n(counted, 5, ["country"], count=COUNT, tie_columns=FIXTURE_KEYS, groups=country_count(spellings))


CUT = {
    "ranked": f"SELECT *, row_number() OVER (PARTITION BY country ORDER BY {KEY_ORDER}) AS rn FROM counted",
    "cut": f"SELECT * FROM ranked WHERE rn <= {SAMPLE_SIZE}", "decoded": DECODED, "finished": finished_sql("cut"),
}


@query("sampler", SAMPLER_VIEWS, "SELECT * FROM finished", {"chosen": chosen_sql(20), "counted": counted_sql("chosen"), **CUT})
def _sampler(spark: SparkSession, sf: str) -> DataFrame:
    return sample_logs(
        _logs(spark, sf), _spellings(spark, sf), _fields(spark, sf), NOW, sample=SAMPLE_SIZE, ago=20, developer_emails=DEVELOPER,
    )


@query("sampler_ordered", SAMPLER_VIEWS, f"""
SELECT CAST(row_number() OVER (ORDER BY search_query_counts DESC, country NULLS FIRST, {", ".join(f"{k} NULLS FIRST" for k in FIXTURE_KEYS)}) AS BIGINT) AS rank,
  country, searched_query, search_query_counts FROM finished""", {"chosen": chosen_sql(20), "counted": counted_sql("chosen"), **CUT})
def _ordered(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_sample(_sampler(spark, sf)).select("rank", "country", "searched_query", COUNT)


@query("precap_sampler", SAMPLER_VIEWS, "SELECT * FROM finished", {
    "chosen": chosen_sql(20),
    "capped": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY {hash_of(['log_id'], '0')}) AS cap
                  FROM chosen) WHERE cap <= 30""",
    "counted": counted_sql("capped"), **CUT,
})
def _precap(spark: SparkSession, sf: str) -> DataFrame:
    return sample_logs(
        _logs(spark, sf), _spellings(spark, sf), _fields(spark, sf), NOW, sample=SAMPLE_SIZE, ago=20, pre_cap=30,
        id_columns=["log_id"], developer_emails=DEVELOPER,
    )


@query("random_sample", SAMPLER_VIEWS, """
SELECT log_id, country, searched_query, components, number_components FROM drawn JOIN decoded d ON populated_fields = d.pf
WHERE searched_query NOT LIKE '%�%'""", {
    "chosen": chosen_sql(365, None), "decoded": DECODED,
    "drawn": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY {hash_of(['log_id'], '7')}) AS rn
                 FROM chosen) WHERE rn <= 20""",
})
def _random(spark: SparkSession, sf: str) -> DataFrame:
    drawn = sample_logs(
        _logs(spark, sf), _spellings(spark, sf), _fields(spark, sf), NOW, sample=20, deduplicate=False, seed=7, id_columns=["log_id"],
    )
    return drawn.select("log_id", "country", "searched_query", "components", "number_components")


@query("seeded_sample", LOGS, f"""
SELECT id, searched_query FROM (SELECT *, row_number() OVER (ORDER BY {hash_of(['id'], '101')}) AS rn FROM numbered)
WHERE rn <= 500""", {"numbered": "SELECT row_number() OVER (ORDER BY log_id) - 1 AS id, searched_query FROM search_logs"})
def _seeded(spark: SparkSession, sf: str) -> DataFrame:
    numbered = row_index(_logs(spark, sf).select("log_id", "searched_query"), ["log_id"])
    return random_sample(numbered, 500, 101, id_columns=["id"]).select("id", "searched_query")


@query("row_index", LOGS, """
SELECT log_id, row_number() OVER (ORDER BY client_received_start_timestamp, log_id) - 1 AS id FROM search_logs""")
def _row_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = _logs(spark, sf).select("log_id", f.TIMESTAMP)
    return row_index(rows, [f.TIMESTAMP, "log_id"]).select("log_id", "id")


BACKFILL_SIZE, BACKFILL_AGO = 12, 30
_edges = window_edges(NOW, BACKFILL_AGO)
WINDOWED = "SELECT c.*, w.window_id FROM chosen c JOIN (" + " UNION ALL ".join(
    f"SELECT {i} AS window_id, TIMESTAMP '{older}' AS older, TIMESTAMP '{newer}' AS newer"
    for i, (newer, older) in enumerate(zip(_edges, _edges[1:]))
) + ") w ON c.client_received_start_timestamp >= w.older AND c.client_received_start_timestamp < w.newer"
SIZES = """
SELECT country, window_id, coalesce(sum(count(*)) OVER (PARTITION BY country ORDER BY window_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM capped GROUP BY country, window_id"""
TAKEN = f"SELECT c.* FROM capped c JOIN sizes z USING (country, window_id) WHERE z.before < {BACKFILL_SIZE}"


@query("adaptive_backfill", SAMPLER_VIEWS, "SELECT * FROM finished", {
    "chosen": chosen_sql(None),
    "windowed": WINDOWED,
    "counted": counted_sql("windowed", "country, window_id"),
    "ranked": f"SELECT *, row_number() OVER (PARTITION BY country, window_id ORDER BY {KEY_ORDER}) AS rn FROM counted",
    "capped": f"SELECT * FROM ranked WHERE rn <= {BACKFILL_SIZE}",
    "sizes": SIZES, "cut": TAKEN, "decoded": DECODED, "finished": finished_sql("cut", "CAST(window_id AS INTEGER) AS window_id,"),
})
def _backfill(spark: SparkSession, sf: str) -> DataFrame:
    return backfill_logs(
        _logs(spark, sf), _spellings(spark, sf), _fields(spark, sf), NOW, sample=BACKFILL_SIZE, ago=BACKFILL_AGO,
        developer_emails=DEVELOPER,
    )


@query("backfill_by_day", SAMPLER_VIEWS, "SELECT * FROM finished", {
    "chosen": chosen_sql(None),
    "windowed": WINDOWED,
    "counted": counted_sql("windowed", "country, window_id"),
    "ranked": f"SELECT *, row_number() OVER (PARTITION BY country, window_id ORDER BY {KEY_ORDER}) AS rn FROM counted",
    "capped": f"SELECT * FROM ranked WHERE rn <= {BACKFILL_SIZE}",
    "sizes": SIZES, "cut": TAKEN, "decoded": DECODED, "finished": finished_sql("cut", "CAST(window_id AS INTEGER) AS window_id,"),
})
def _backfill_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return backfill_logs(
        _by_day(spark, sf), _spellings(spark, sf), _fields(spark, sf), NOW, sample=BACKFILL_SIZE, ago=BACKFILL_AGO,
        developer_emails=DEVELOPER, day=f.DAY,
    )


RANDOM_ORDER = hash_of(["log_id"], "7")


@query("backfill_random", SAMPLER_VIEWS, """
SELECT log_id, country, CAST(window_id AS INTEGER) AS window_id, searched_query, d.components, d.number_components
FROM cut JOIN decoded d ON populated_fields = d.pf WHERE searched_query NOT LIKE '%�%'""", {
    "chosen": chosen_sql(None),
    "windowed": WINDOWED,
    "ranked": f"SELECT *, row_number() OVER (PARTITION BY country, window_id ORDER BY {RANDOM_ORDER}) AS rn FROM windowed",
    "capped": f"SELECT * FROM ranked WHERE rn <= {BACKFILL_SIZE}",
    "sizes": SIZES, "cut": TAKEN, "decoded": DECODED,
})
def _backfill_random(spark: SparkSession, sf: str) -> DataFrame:
    drawn = backfill_logs(
        _logs(spark, sf), _spellings(spark, sf), _fields(spark, sf), NOW, sample=BACKFILL_SIZE, ago=BACKFILL_AGO,
        deduplicate=False, id_columns=["log_id"], seed=7, developer_emails=DEVELOPER,
    )
    return drawn.select("log_id", "country", "window_id", "searched_query", "components", "number_components")
