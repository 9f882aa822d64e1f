"""Filters, deduplication, ranked and random samples, back-fill."""

from __future__ import annotations

import datetime as dt
import glob
import hashlib
import os
import random
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import bag, plan
from waymark.operators import filters as f
from waymark.operators import ranking
from waymark.operators.backfill import adaptive_backfill, window_edges
from waymark.operators.dedup import COUNT, dedup_count
from waymark.operators.dimensions import (
    country_to_iso2, decode_fields, decode_fields_join, in_countries, iso2_codes, match_countries, spelling_sets,
)
from waymark.operators.ranking import first_n, order_by_count, random_sample
from waymark.plans import sampling
from waymark.plans.sampling import finish_sample, most_repeated, sample_logs, sample_name
from waymark.sources.sinks import write_log_by_day

NOW = dt.datetime(2024, 1, 31)
SPELLINGS = "country_code string, spelling string"


def spellings(spark):
    return spark.createDataFrame([("ES", "España"), ("ES", "Spain"), ("US", "America"), ("XX", "america"), ("US", "US")], SPELLINGS)


def fields(spark):
    return spark.createDataFrame([(4, "number"), (5, "road"), (6, "city")], "populated_field_id int, populated_field_description string")


def logs(spark, rows):
    names = ["ts", "searched_query", "populated_fields", "countryName", "who_searched", "method_name", "developer_email"]
    default = dict(
        ts=NOW - dt.timedelta(days=1), searched_query="q", populated_fields="|4|5|", countryName="Spain",
        who_searched="Full Address Search", method_name="search 2 search", developer_email="a@b",
    )
    data = [tuple({**default, **row}[n] for n in names) for row in rows]
    schema = "ts timestamp_ntz, " + ", ".join(f"{n} string" for n in names[1:])
    return spark.createDataFrame(data, schema).withColumnRenamed("ts", f.TIMESTAMP)


def kept(df, condition, column):
    return sorted((r[column] for r in df.where(condition).collect()), key=str)


def test_look_back_is_strict_and_takes_text(spark):
    df = logs(spark, [{"ts": NOW - dt.timedelta(days=d), "searched_query": str(d)} for d in (1, 20, 21)])
    assert kept(df, f.looked_back(NOW, "20"), "searched_query") == ["1"]
    assert kept(df, f.looked_back(NOW, None), "searched_query") == ["1", "20", "21"]


def test_date_ranges_that_touch_share_no_row(spark):
    df = logs(spark, [{"ts": NOW - dt.timedelta(days=d), "searched_query": str(d)} for d in (5, 10, 15)])
    assert kept(df, f.in_date_range(NOW, 10, 5), "searched_query") == ["10"]
    assert kept(df, f.in_date_range(NOW, 15, 10), "searched_query") == ["15"]
    with pytest.raises(ValueError):
        f.in_date_range(NOW, 5, 10)


def test_exclusions_keep_missing_values(spark):
    df = logs(spark, [{"developer_email": e} for e in ("", None, "DEV@x", "other@x")])
    assert kept(df, f.not_named("developer_email", "dev@X"), "developer_email") == ["", None, "other@x"]
    assert kept(df, f.not_named("developer_email", ["dev@x", ""]), "developer_email") == [None, "other@x"]
    assert len(kept(df, f.not_named("developer_email", None), "developer_email")) == 4


def test_names_and_texts(spark):
    df = logs(spark, [
        {"method_name": "Search 2 Search", "searched_query": None}, {"method_name": "search 2 nearbySearch", "searched_query": "a�"},
        {"method_name": None, "populated_fields": "4", "searched_query": "b"},
    ])
    assert kept(df, f.named("method_name", ("search 2 search",)), "method_name") == ["Search 2 Search"]
    assert set(kept(df, f.not_nearby(), "method_name")) == {None, "Search 2 Search"}
    assert set(kept(df, f.readable(), "searched_query")) == {None, "b"}
    assert kept(df, f.with_populated_fields(["4"]), "populated_fields") == ["4"]


@pytest.mark.parametrize("call", [
    lambda: f.named("method_name", "search 2 search"),
    lambda: f.not_named("developer_email", 5),
    lambda: f.with_populated_fields("4"),
    lambda: f.not_named("developer_email", [1]),
])
def test_wrong_arguments(spark, call):
    with pytest.raises(ValueError):
        call()


@pytest.mark.parametrize("size", [-1, 1.5, True, "10"])
def test_wrong_sample_sizes(size):
    with pytest.raises(ValueError):
        ranking.check_size(size)


@pytest.fixture(params=["broadcast", "salted"])
def either_join(request):
    if request.param == "salted":
        request.getfixturevalue("nothing_fits")


def test_countries(spark, either_join):
    df = logs(spark, [{"countryName": c} for c in ["spain"] * 7 + ["SPAIN", "AMERICA", "Mars", None]])
    assert bag(match_countries(df, spellings(spark)), "countryName", "country") == Counter({
        ("spain", "ES"): 7, ("SPAIN", "ES"): 1, ("AMERICA", "US"): 1, ("AMERICA", "XX"): 1,
    })
    assert bag(in_countries(df, spellings(spark), ["US", "XX"]), "countryName") == Counter({("AMERICA",): 1})
    named = country_to_iso2(df.select("countryName"), spellings(spark), "countryName", "code")
    assert bag(named, "countryName", "code") == Counter({
        ("spain", "ES"): 7, ("SPAIN", "ES"): 1, ("AMERICA", "US"): 1, ("Mars", "not found"): 1, (None, "not found"): 1,
    })
    assert iso2_codes("Spain", spellings(spark)) == ["ES"]
    assert iso2_codes(["us", "Mars"], spellings(spark)) == ["US", "not found"]


def test_spelling_sets(spark):
    names = spark.createDataFrame(
        [("es", "en", "Spain"), ("es", "nl", "Spanje"), ("es", "de", "Spain"), ("es", "spa", "España")],
        "country_code string, language string, name string")
    codes = spark.createDataFrame([("es", "ESP", "Kingdom of Spain"), ("fr", "FRA", None)], "country_code string, iso3 string, official_name string")
    got = {r["country_code"]: r["spellings"] for r in spelling_sets(names, codes).collect()}
    assert got == {"es": ["ES", "ESP", "Kingdom of Spain", "Spain", "Spanje"], "fr": ["FR", "FRA"]}
    only = spelling_sets(names, codes, ["spa"]).where("country_code = 'es'").first()["spellings"]
    assert only == ["ES", "ESP", "España", "Kingdom of Spain"]
    arrays = spark.createDataFrame([("ES", ["Spain", "Spanje"])], "country_code string, spellings array<string>")
    assert iso2_codes(["spanje"], arrays) == ["ES"]


@pytest.mark.parametrize("decode", [decode_fields, decode_fields_join])
def test_decoded_fields(spark, decode, either_join):
    df = logs(spark, [{"populated_fields": p} for p in ["|4|5|"] * 5 + ["", "6|4|6", None]])
    expected = Counter({("|4|5|", "number|road", 2): 5, ("", "", 0): 1, ("6|4|6", "city|number|city", 3): 1, (None, None, None): 1})
    assert bag(decode(df, fields(spark)), "populated_fields", "components", "number_components") == expected


@pytest.mark.parametrize("decode", [decode_fields, decode_fields_join])
def test_unknown_fields(spark, decode):
    df = logs(spark, [{"populated_fields": "4|99"}])
    assert bag(decode(df, fields(spark), strict=False), "components", "number_components") == Counter({("number", 1): 1})
    with pytest.raises(Exception, match="unknown populated field"):
        decode(df, fields(spark)).collect()


def test_dedup_counts_add_up(spark):
    df = logs(spark, [{"searched_query": q} for q in "aaabbc"] + [{"searched_query": "a", "developer_email": None}])
    counted = dedup_count(df)
    assert bag(counted, "searched_query", "developer_email", COUNT) == Counter({
        ("a", "a@b", 3): 1, ("b", "a@b", 2): 1, ("c", "a@b", 1): 1, ("a", None, 1): 1,
    })
    assert counted.agg(F.sum(COUNT)).first()[0] == 7
    assert [r[COUNT] for r in order_by_count(counted).collect()] == [3, 2, 1, 1]


def hashed(*parts):
    return hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()


def ranked_rows(rows, n):
    """Brute force: rows (group, key, count) by count and hash, the first n of each group."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    return Counter(r for g in groups.values() for r in sorted(g, key=lambda r: (-r[2], hashed(r[1]), r[1]))[:n])


@pytest.mark.parametrize("groups", [None, 10])
@pytest.mark.parametrize("digits", [0, 1, 4])
@pytest.mark.parametrize("n", [1, 7, 60, 1000])
def test_first_n_against_brute_force(spark, monkeypatch, digits, n, groups):
    monkeypatch.setattr(ranking, "DIGITS", digits)
    draw = random.Random(digits * n)
    rows = [("hot" if i % 3 else [None, "g1", "g2"][i // 3 % 3], f"k{i}", draw.choice([1, 1, 1, 2, 3, 50])) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, k string, c int")
    got = first_n(df, n, ["g"], count="c", tie_columns=["k"], groups=groups)
    assert bag(got, "g", "k", "c") == ranked_rows(rows, n)


def test_first_n_without_groups_or_limit(spark):
    rows = [("g", f"k{i}", i % 3) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, k string, c int").where("c > 0")
    assert bag(first_n(df, 9, count="c", tie_columns=["k"]), "g", "k", "c") == ranked_rows([r for r in rows if r[2]], 9)
    assert first_n(df, None).count() == df.count()
    assert first_n(df, 0).count() == 0


def test_random_sample_by_id(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 2)
    first = bag(random_sample(df, 40, seed=1, by=["g"], id_columns=["id"]), "id", "g")
    assert sum(first.values()) == 80
    assert first == bag(random_sample(df.repartition(5), 40, seed=1, by=["g"], id_columns=["id"]), "id", "g")
    assert first != bag(random_sample(df, 40, seed=2, by=["g"], id_columns=["id"]), "id", "g")
    expected = sorted(range(500), key=lambda i: hashed(i, 101))[:30]
    assert sorted(r["id"] for r in random_sample(df, 30, 101, id_columns=["id"]).collect()) == sorted(expected)


@pytest.mark.parametrize("n", [1, 5, 199, 200, 205, 500])
def test_random_sample_of_copies(spark, n):
    rows = [("same",)] * 200 + [(f"r{i}",) for i in range(20)]
    df = spark.createDataFrame(rows, "v string")
    taken = bag(random_sample(df, n, seed=3), "v")
    assert sum(taken.values()) == min(n, 220)
    assert all(count <= Counter((r[0],) for r in rows)[key] for key, count in taken.items())


def test_sample_of_a_country(spark):
    df = logs(spark, [
        *[{"searched_query": "hot", "countryName": "spain"}] * 5, *[{"searched_query": "warm"}] * 3, {"searched_query": "cold"},
        {"searched_query": "broken �"}, {"searched_query": "poi", "method_name": "SEARCH 2 POISEARCH"},
        {"searched_query": "partial", "who_searched": "Partial"}, {"searched_query": "old", "ts": NOW - dt.timedelta(days=400)},
    ])
    sample = sample_logs(df, spellings(spark), fields(spark), NOW, sample=2)
    assert bag(sample, "searched_query", "countryName", "country", "components", "number_components", COUNT) == Counter({
        ("hot", "SPAIN", "ES", "number|road", 2, 5): 1, ("warm", "SPAIN", "ES", "number|road", 2, 3): 1,
    })
    everything = sample_logs(
        df, spellings(spark), fields(spark), NOW, sample=None, ago=None, only_full_addresses=False, exclude_endpoints=None,
        countries=["ES"],
    )
    assert {r["searched_query"] for r in everything.collect()} == {"hot", "warm", "cold", "poi", "partial", "old"}
    lone = sample_logs(df, spellings(spark), fields(spark), NOW, countries="es", sample=1)
    assert bag(lone, "searched_query", "country") == Counter({("hot", "ES"): 1})
    with pytest.raises(ValueError):
        sample_logs(df, spellings(spark), fields(spark), NOW, countries=5)
    rows = sample_logs(df, spellings(spark), fields(spark), NOW, sample=4, deduplicate=False)
    assert rows.count() in (3, 4) and COUNT not in rows.columns


def test_missing_developer_column_is_added(spark):
    df = logs(spark, [{}]).drop("developer_email")
    sample = sample_logs(df, spellings(spark), fields(spark), NOW, developer_emails=["x"])
    assert [r["developer_email"] for r in sample.collect()] == [""]
    assert "developer_email" in finish_sample(df, fields(spark)).columns


@pytest.mark.parametrize("by", [[], ["country"]])
def test_a_small_sample_is_one_scan(spark, by, tmp_path):
    """Both ways take the same rows; the small one reads the table once and shuffles few rows of a task."""
    path = str(tmp_path / "rows")
    spark.range(20_000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 9 == 0, None).otherwise("few").alias("country"), F.col("id")).repartition(6).write.parquet(path)
    rows = spark.read.parquet(path)
    small = random_sample(rows, 40, 5, by, ["id"])
    text = plan(small)
    assert text.count("Scan parquet") == 2 and ("WindowGroupLimit" in text or "TakeOrderedAndProject" in text)
    own, ranking.TASK_ROWS = ranking.TASK_ROWS, 0
    try:
        large = random_sample(rows, 40, 5, by, ["id"])
        assert bag(large) == bag(small) and small.count() == (40 * 3 if by else 40)
    finally:
        ranking.TASK_ROWS = own


@pytest.mark.parametrize("sample", [1, 7, 60, 10_000])
def test_most_repeated_by_digests_and_by_whole_requests(spark, sample, monkeypatch):
    """Ties at the bound, missing keys, a request with most rows, and requests of one digest."""
    draw = random.Random(sample)
    rows = [("ES", "hot", None)] * 300 + [(draw.choice(["ES", "FR"]), f"q{draw.randrange(200)}", draw.choice([None, "", "x"])) for _ in range(600)]
    chosen = spark.createDataFrame(rows, "country string, searched_query string, developer_email string")
    by_digest = most_repeated(chosen, sample, 2)
    assert "LeftSemi" in plan(by_digest)
    monkeypatch.setattr(sampling, "BROADCAST_ROWS", 0)
    whole = most_repeated(chosen, sample, 2)
    assert "LeftSemi" not in plan(whole)
    assert bag(by_digest) == bag(whole) and by_digest.count() > 0


def test_requests_of_one_digest_keep_their_own_counts(spark, monkeypatch):
    monkeypatch.setattr(sampling, "row_hash", lambda keys: F.md5(F.substring(keys[0], 1, 1)))
    chosen = spark.createDataFrame([("ES", "a1")] * 3 + [("ES", "a2")] * 2 + [("ES", "b")], "country string, searched_query string")
    assert bag(most_repeated(chosen, 1, 1)) == Counter({("ES", 3, "a1"): 1, ("ES", 2, "a2"): 1})


def test_sample_names():
    assert sample_name(True, dt.date(2022, 11, 9)) == "complete_responses_09-11-2022"
    assert sample_name(False, dt.date(2022, 11, 9)) == "incomplete_responses_09-11-2022"


def backfilled(rows, sample, ago):
    """Brute force: window after window until there are `sample` rows."""
    edges = window_edges(NOW, ago)
    taken: Counter = Counter()
    for number, (newer, older) in enumerate(zip(edges, edges[1:])):
        if sum(taken.values()) >= sample:
            break
        counts = Counter(q for ts, q in rows if older <= ts < newer)
        best = sorted(counts.items(), key=lambda item: (-item[1], hashed(item[0])))[:sample]
        taken.update((number, q, c) for q, c in best)
    return taken


@pytest.mark.parametrize("sample", [1, 4, 9, 100])
@pytest.mark.parametrize("countries", [None, 5])
def test_backfill_against_brute_force(spark, sample, countries):
    draw = random.Random(sample)
    rows = [(NOW - dt.timedelta(days=draw.uniform(0, 35)), draw.choice("abcdef")) for _ in range(200)]
    rows += [(edge, "edge") for edge in window_edges(NOW, 30)]
    df = spark.createDataFrame(rows, f"{f.TIMESTAMP} timestamp_ntz, searched_query string").withColumn("country", F.lit("ES"))
    got = adaptive_backfill(df, NOW, sample, "30", countries)
    assert bag(got, "window_id", "searched_query", COUNT) == backfilled(rows, sample, 30)


def many_countries(spark):
    """Countries that fill from the first window, later, never, and one that has only old rows."""
    draw = random.Random(6)
    rows = [("ES", draw.uniform(15, 30), draw.choice("abcdefghij")) for _ in range(400)]
    rows += [("FR", draw.uniform(19, 30), draw.choice("abcdefgh")) for _ in range(150)]
    rows += [("IT", draw.uniform(15, 30), draw.choice("ab")) for _ in range(9)] + [("PT", draw.uniform(28, 30), draw.choice("abcd")) for _ in range(40)]
    made = [(c, NOW - dt.timedelta(days=d), q) for c, d, q in rows]
    return made, spark.createDataFrame(made, f"country string, {f.TIMESTAMP} timestamp_ntz, searched_query string")


@pytest.mark.parametrize("countries", [None, 4, 30])
@pytest.mark.parametrize("deduplicate", [True, False])
def test_backfill_of_several_countries(spark, countries, deduplicate):
    rows, df = many_countries(spark)
    got = adaptive_backfill(df, NOW, 7, 30, countries, deduplicate=deduplicate, id_columns=None if deduplicate else [f.TIMESTAMP])
    for country in ("ES", "FR", "IT", "PT"):
        own = [(ts, q) for c, ts, q in rows if c == country]
        if deduplicate:
            assert bag(got.where(F.col("country") == country), "window_id", "searched_query", COUNT) == backfilled(own, 7, 30)
        else:
            edges = window_edges(NOW, 30)
            want, held = {}, 0
            for number, (newer, older) in enumerate(zip(edges, edges[1:])):
                n = min(7, sum(older <= ts < newer for ts, _ in own))
                if n and held < 7:
                    want[number], held = n, held + n
            assert Counter(r["window_id"] for r in got.where(F.col("country") == country).collect()) == want


def test_backfill_does_not_read_old_days(spark, tmp_path):
    """Folders of days that no country needs hold files that cannot be read."""
    _, df = many_countries(spark)
    few = df.where("country = 'ES'")
    path = str(tmp_path / "log")
    write_log_by_day(few.withColumn("countryName", F.lit("Spain")), path)
    want = bag(adaptive_backfill(few, NOW, 7, 30, 1))
    # The first window of the sample reaches back to the sixteenth day.
    for folder in glob.glob(f"{path}/{f.DAY}=*"):
        if dt.date.fromisoformat(folder.rsplit("=")[1]) < (NOW - dt.timedelta(days=17)).date():
            for file in glob.glob(f"{folder}/*.parquet"):
                with open(file, "wb") as out:
                    out.write(b"not parquet")
                os.remove(f"{folder}/.{os.path.basename(file)}.crc")
    logs_by_day = spark.read.schema(few.withColumn("countryName", F.lit("Spain")).withColumn(f.COUNTRY_NAME, F.lit("x")).withColumn(f.DAY, F.current_date()).schema).parquet(path)
    got = adaptive_backfill(logs_by_day.drop("countryName", f.COUNTRY_NAME), NOW, 7, 30, 1, day=f.DAY)
    assert bag(got) == want
    with pytest.raises(Exception, match="(?i)parquet"):
        logs_by_day.select("searched_query").collect()


def test_a_log_by_day_is_pruned(spark, tmp_path):
    path = str(tmp_path / "log")
    logs_ = spark.range(60_000).select(
        F.col("id"), F.concat(F.lit("Land "), (F.col("id") % 40).cast("string")).alias("countryName"), F.sha2(F.col("id").cast("string"), 256).alias("searched_query"),
        F.when(F.col("id") % 997 == 0, None).otherwise(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 4 as int), cast(id % 24 as int))")).alias(f.TIMESTAMP),
    )
    write_log_by_day(logs_, path, row_group_bytes=64 << 10)
    back = spark.read.parquet(path)
    assert bag(back.select(*logs_.columns).select("id", "countryName")) == bag(logs_.select("id", "countryName"))
    kept = back.where(f.on_days(dt.datetime(2024, 1, 4), 2, 1) & f.country_named(["LAND 7"]))
    text = plan(kept)
    assert f"PartitionFilters: [isnotnull({f.DAY}" in text and f"EqualTo({f.COUNTRY_NAME},land 7)" in text.replace("In(", "EqualTo(").replace("[land 7]", "land 7")
    assert {r["id"] for r in kept.collect()} == {i for i in range(60_000) if i % 997 and i % 40 == 7 and i % 4 == 1}
    # Within a day a country's rows lie in few row groups.
    files = [pq.ParquetFile(p) for p in glob.glob(f"{path}/{f.DAY}=2024-01-02/*.parquet")]
    place = files[0].schema_arrow.get_field_index(f.COUNTRY_NAME)
    groups = [m.metadata.row_group(i).column(place).statistics for m in files for i in range(m.metadata.num_row_groups)]
    matching = [g for g in groups if g.min <= "land 7" <= g.max]
    assert len(groups) >= 8 and len(matching) <= len(groups) / 3
    assert back.where(F.col(f.DAY).isNull()).count() == 61


def test_backfill_needs_more_than_fifteen_days():
    with pytest.raises(ValueError):
        window_edges(NOW, 15)


def test_chosen_rows_spread_evenly(spark):
    # Two counts: all rows of the first are chosen, and a part of the second.
    df = spark.range(80_000).select(F.lit("ES").alias("country"), F.col("id"), F.when(F.col("id") % 2 == 0, 2).otherwise(1).alias(COUNT))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = first_n(df, 50_000, ["country"], count=COUNT, tie_columns=["id"], groups=1)
        sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 50_000 and made.where(F.col(COUNT) == 2).count() == 40_000
    assert max(sizes) < 2 * 50_000 / int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("decode", [decode_fields, decode_fields_join])
def test_repeated_field_ids(spark, decode):
    logs = spark.createDataFrame([("1|2",), ("2",)], "populated_fields string")
    same = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "populated_field_id int, populated_field_description string")
    assert bag(decode(logs, same), "populated_fields", "components") == Counter({("1|2", "a|b"): 1, ("2", "b"): 1})
    two = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "populated_field_id int, populated_field_description string")
    with pytest.raises(Exception, match="two names"):
        decode(logs, two).collect()


def test_both_decoders_agree_on_many_names(spark):
    fields = spark.range(600).select(F.col("id").alias("populated_field_id"), F.concat(F.lit("f"), "id").alias("populated_field_description"))
    logs = spark.range(300).select(F.concat_ws("|", F.col("id"), F.col("id") * 2, F.lit("")).alias("populated_fields"))
    assert bag(decode_fields(logs, fields)) == bag(decode_fields_join(logs, fields))
