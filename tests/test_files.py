"""Sources, sinks and streams."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import bag, plan
from waymark.operators.dedup import dedup_count
from waymark.plans.geocoding import geocode_file
from waymark.plans.preprocess import preprocess, preprocess_file
from waymark.sources import sinks
from waymark.sources.records import get_records, put_record
from waymark.sources.sinks import write_country_results, write_country_samples, write_results
from waymark.sources.tables import path_format, read_by_format, scan_logs
from waymark.streaming import retry
from waymark.streaming.counts import count_requests, request_counts
from waymark.streaming.parse import parse_stream
from waymark.streaming.retry import client_filler, fill_if_null, read_rounds, retry_until_filled, start_unanswered
from waymark.streaming.sinks import append_stream, read_saved, read_stream

AWKWARD = [("a;b", 'say "x"'), ("line\nbreak", ""), (None, "tab\tand\\slash"), ("", None)]


@pytest.mark.parametrize("path, kind", [
    ("a/b.csv", "csv"), ("a.b/c.parquet", "parquet"), ("x.csv.gz", "gz"), ("a.b/c", "b"), ("plain", None), (".csv", None),
])
def test_format_of_a_path(path, kind):
    assert path_format(path) == kind


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_files_come_back_as_written(spark, tmp_path, kind):
    df = spark.createDataFrame(AWKWARD, "a string, b string")
    path = str(tmp_path / f"out.{kind}")
    if kind == "csv":
        df.write.options(sep=";", header=True, escape='"').csv(path)
    else:
        df.write.parquet(path)
    assert bag(read_by_format(spark, path, line_breaks=True)) == bag(df)
    assert bag(read_by_format(spark, path, schema=df.schema, line_breaks=True)) == bag(df)


def test_one_large_csv_is_many_tasks(spark, tmp_path):
    path = str(tmp_path / "large.csv")
    spark.range(20_000).withColumn("t", F.repeat(F.lit("x"), 500)).coalesce(1).write.options(sep=";", header=True).csv(path)
    limit = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(limit, "1m")
    try:
        assert read_by_format(spark, path).rdd.getNumPartitions() > 4
        assert read_by_format(spark, path).count() == 20_000
    finally:
        spark.conf.unset(limit)


def test_other_formats_are_refused(spark, tmp_path):
    for path in ("x.json", "plain"):
        with pytest.raises(ValueError):
            read_by_format(spark, path)
    with pytest.raises(ValueError):
        write_country_samples(spark.range(1).withColumn("country", F.lit("x")), str(tmp_path), "json", columns=None)


def test_scan_by_name_and_path(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("some_logs")
    assert scan_logs(spark, "some_logs").count() == 3
    spark.range(4).write.parquet(str(tmp_path / "p"))
    assert scan_logs(spark, path=str(tmp_path / "p"), schema="id long").count() == 4
    with pytest.raises(ValueError):
        scan_logs(spark)


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_samples_by_country(spark, tmp_path, kind):
    df = spark.createDataFrame([(a, b, c) for (a, b), c in zip(AWKWARD, ["ES", "ES", "NO", "US"])], "a string, b string, country string")
    write_country_samples(df, str(tmp_path / "s"), kind, columns=["country", "a", "b"])
    assert {n for n in os.listdir(tmp_path / "s") if n.startswith("country=")} == {"country=ES", "country=NO", "country=US"}
    saved = read_by_format(spark, str(tmp_path / "s"), schema=df.select("country", "a", "b").schema, file_format=kind, line_breaks=True)
    assert bag(saved, "a", "b", "country") == bag(df, "a", "b", "country")


def test_results_are_not_written_without_a_path(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, "a string, b string")
    write_results(df, "")
    write_results(df, None)
    write_results(df, str(tmp_path / "r.csv"))
    assert bag(read_by_format(spark, str(tmp_path / "r.csv"), sep=",", line_breaks=True)) == bag(df)


def test_country_results_and_status(spark, tmp_path):
    df = spark.createDataFrame([("ES", "1.5", "-2.5"), ("FR", "x", "1")], "country string, lat string, lon string")
    status = write_country_results(df, ["ES", "US"], str(tmp_path / "c"))
    assert bag(status, "country", "status") == Counter({("ES", "Done"): 1, ("US", "Incomplete"): 1})
    files = [n for n in os.listdir(tmp_path / "c" / "country=ES") if n.endswith(".csv")]
    lines = (tmp_path / "c" / "country=ES" / files[0]).read_text().splitlines()
    assert lines == ["lat\tlon\tcoordinates", "1.5\t-2.5\tPOINT (-2.5 1.5)"]
    assert not (tmp_path / "c" / "country=FR").exists()


def test_rows_of_a_country_are_shared_out_by_number(spark, monkeypatch):
    # Rows all alike, which compress to almost nothing.
    monkeypatch.setattr(sinks, "ROWS_PER_FILE", 500)
    df = spark.range(12_000).select(F.when(F.col("id") < 10_000, "ES").when(F.col("id") < 11_000, "NO").alias("country"), F.lit("same").alias("a"))
    placed = sinks.by_country(df)
    tasks = [row["count"] for row in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) < 1000
    assert bag(placed.groupBy("country").count(), "country", "count") == Counter({("ES", 10_000): 1, ("NO", 1000): 1, (None, 1000): 1})
    sinks.by_country(df.where("false")).collect()


LOG = "n int, method_name string, searched_query string, lib_postal_result string, parsed_request_quertystring string"
LOGS = [
    (1, "search 2 structuredGeocode", "old", '{"city":"a"}', '{"municipality":"b%20c"}'),
    (2, "search 2 search", "kept", '{"city":"a"}', "{}"),
    (3, "search 2 nearbySearch", "kept", "x", "{}"),
]


def test_preprocessed_and_geocoded_files(spark, tmp_path):
    path, parsed, results = (str(tmp_path / n) for n in ("logs.parquet", "parsed.parquet", "results.csv"))
    spark.createDataFrame(LOGS, LOG).write.parquet(path)
    saved = preprocess_file(spark, path, parsed)
    assert bag(saved) == bag(preprocess_file(spark, path))
    assert bag(saved, "n", "searched_query") == Counter({(1, "b c"): 1, (2, "kept"): 1, (3, "kept"): 1})
    reply = '{"summary":{"query":"k"},"results":[{"type":"t","matchConfidence":{"score":0.9},"position":{"lat":1.0,"lon":2.0}}]}'
    responses = spark.createDataFrame([("kept", reply)], "searched_query string, response string")
    got = geocode_file(spark, parsed, responses, ["n"], save_path=results)
    assert bag(got, "id", "searched_query") == Counter({(1, "kept"): 1})
    assert bag(read_by_format(spark, results, schema=got.schema, sep=",")) == bag(got)


def test_a_stream_parses_like_a_batch_and_goes_on(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    df = spark.createDataFrame(LOGS, LOG)
    df.where("n < 3").write.parquet(source)
    parse_stream(spark, source, df.schema, out, state)
    assert bag(read_saved(spark, out)) == bag(preprocess(df.where("n < 3")))
    df.where("n = 3").write.mode("append").parquet(source)
    parse_stream(spark, source, df.schema, out, state, files_per_batch=1)
    assert bag(read_saved(spark, out)) == bag(preprocess(df))


def test_append_stream_by_partition(spark, tmp_path):
    spark.range(10).withColumn("k", F.col("id") % 2).write.parquet(str(tmp_path / "in"))
    stream = read_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    append_stream(stream, str(tmp_path / "out"), str(tmp_path / "state"), by=["k"])
    assert read_saved(spark, str(tmp_path / "out")).where("k = 1").count() == 5


def pois(spark, n=9):
    return spark.range(n).select(F.col("id").cast("int").alias("reference_id"), F.concat(F.lit("p"), "id").alias("name"))


def answers_from(spark, last=3):
    """A filler that answers row i in round i % last + 1, and never for multiples of five."""
    table = spark.range(50).where("id % 5 > 0").select(
        F.col("id").cast("int").alias("reference_id"), (F.col("id") % last + 1).alias("_from"),
        F.array(F.create_map(F.lit("id"), F.col("id").cast("string"))).alias("found"),
    )
    return lambda rows, number: rows.join(table.where(F.col("_from") <= number).drop("_from"), "reference_id", "left")


def test_rounds_until_filled(spark):
    df = pois(spark).where("reference_id % 5 > 0")
    rounds = retry_until_filled(df, answers_from(spark))
    assert (rounds.count, rounds.remaining) == (3, 0)
    assert rounds.reports == [[(0, 1, 5), (1, 1, 2)], [(0, 2, 2), (1, 2, 3)], [(1, 3, 2)]]
    rows = read_rounds(df, rounds).collect()
    assert {r["reference_id"]: (r["apiCalls"], r["apiResults"]) for r in rows} == {
        i: (i % 3 + 1, [{"id": str(i)}]) for i in range(9) if i % 5
    }


def test_rounds_end_at_the_bound_or_when_idle(spark):
    rounds = retry_until_filled(pois(spark), answers_from(spark), max_rounds=4)
    assert (rounds.count, rounds.remaining) == (4, 2)
    rows = {r["reference_id"]: (r["apiCalls"], r["apiResults"]) for r in read_rounds(pois(spark), rounds).collect()}
    assert rows[0] == (4, None) and rows[5] == (4, None) and len(rows) == 9
    idle = retry_until_filled(pois(spark), answers_from(spark), stop_when_idle=True)
    assert (idle.count, idle.remaining) == (4, 2)
    assert bag(read_rounds(pois(spark), idle).drop("apiResults")) == bag(read_rounds(pois(spark), rounds).drop("apiResults"))
    none = retry_until_filled(pois(spark), answers_from(spark), max_rounds=0)
    assert read_rounds(pois(spark), none).count() == 9


def test_rounds_are_kept_where_asked(spark, tmp_path):
    rounds = retry_until_filled(pois(spark, 4), answers_from(spark, 1), max_rounds=1, folder=str(tmp_path / "r"))
    assert rounds.folder == str(tmp_path / "r")
    assert read_saved(spark, str(tmp_path / "r" / "rows" / "round=1")).where("api_status = 1").count() == 3


class Broken(Exception):
    pass


@pytest.mark.parametrize("at", [0, 4])
def test_a_broken_run_goes_on(spark, tmp_path, at, monkeypatch):
    """The driver's loop ends inside round 2, before its first micro-batch or between two of them."""
    df = pois(spark, 30).repartition(4)
    whole = retry_until_filled(df, answers_from(spark), stop_when_idle=True, files_per_batch=1)
    folder, asked, batches = str(tmp_path / "rounds"), [], [0]
    own = retry._save_batch

    def save(rows, root, number, batch):
        if number == 2:
            batches[0] += 1
            if at == 0 or batches[0] == 3:
                raise Broken
        lines = own(rows, root, number, batch)
        asked.extend((number, r["reference_id"]) for r in rows.collect())
        return lines

    monkeypatch.setattr(retry, "_save_batch", save)
    with pytest.raises(Exception, match="Broken"):
        retry_until_filled(df, answers_from(spark), stop_when_idle=True, files_per_batch=1, folder=folder)
    before = len(asked)
    assert (len(asked) > 30 + 30) == (at > 0)
    monkeypatch.setattr(retry, "_save_batch", lambda rows, root, number, batch: asked.extend(
        (number, r["reference_id"]) for r in rows.collect()) or own(rows, root, number, batch))
    rounds = retry_until_filled(df, answers_from(spark), stop_when_idle=True, files_per_batch=1, folder=folder)
    assert len(asked) == len(set(asked)) and not {n for n, _ in asked[before:]} & {0, 1}
    assert (rounds.count, rounds.remaining, rounds.reports) == (whole.count, whole.remaining, whole.reports)
    assert bag(read_rounds(df, rounds).withColumn("apiResults", F.to_json("apiResults"))) == bag(
        read_rounds(df, whole).withColumn("apiResults", F.to_json("apiResults")))
    # Nothing is left to do: a third call asks nobody.
    done = len(asked)
    again = retry_until_filled(df, answers_from(spark), stop_when_idle=True, folder=folder)
    assert len(asked) == done and again.reports == whole.reports


def test_a_first_write_that_broke_off_is_made_again(spark, tmp_path):
    folder = str(tmp_path / "rounds")
    pois(spark, 2).write.parquet(f"{folder}/rows/round=0/batch=0")
    rounds = retry_until_filled(pois(spark, 4), answers_from(spark, 1), stop_when_idle=True, folder=folder)
    assert read_rounds(pois(spark, 4), rounds).count() == 4


def test_records(spark, tmp_path):
    folder = str(tmp_path / "records")
    assert get_records(spark, folder) == {}
    put_record(spark, folder, "a", {"n": 1})
    put_record(spark, folder, "a", {"n": 2})
    put_record(spark, folder, "b", {"n": 3})
    assert get_records(spark, folder) == {"a": {"n": 2}, "b": {"n": 3}}


def counting_client(folder, width):
    """A client that fails for every seventh name, answers later for smaller ones, and notes how many calls run at a time."""

    def make():
        import os
        import time

        def ask(row):
            mark = os.path.join(folder, row["name"])
            open(mark, "w").close()
            assert len(os.listdir(folder)) <= width, "too many calls"
            time.sleep(0.002 * (20 - int(row["name"][1:]) % 20))
            os.remove(mark)
            if int(row["name"][1:]) % 7 == 0:
                raise TimeoutError(row["name"])
            return [{"id": row["name"]}]

        return ask

    return make


@pytest.mark.parametrize("width", [1, 6])
def test_calls_in_flight(spark, tmp_path, width):
    rows = start_unanswered(pois(spark, 60).coalesce(1))
    filler = client_filler(counting_client(str(tmp_path), width), ["name"], in_flight=width, failures=(TimeoutError,))
    got = {r["name"]: r["apiResults"] for r in fill_if_null(rows, filler).collect()}
    assert got == {f"p{i}": [{"id": f"p{i}"}] if i % 7 else None for i in range(60)}


def test_other_failures_of_a_client_end_the_task(spark, tmp_path):
    filler = client_filler(counting_client(str(tmp_path), 4), ["name"], failures=(ConnectionError,))
    with pytest.raises(Exception, match="TimeoutError"):
        fill_if_null(start_unanswered(pois(spark)), filler).collect()
    with pytest.raises(ValueError):
        client_filler(even_names(), ["name"], in_flight=0)


DAY = "2024-01-{:02d} {:02d}:00:00"


def deliveries(spark):
    """Requests a and b by day; the second delivery brings one row in time and one late, the third a late one."""
    rows = [
        [("a", 1, 1), ("a", 1, 2), ("b", 2, 3), ("a", 5, 4)],
        [("a", 2, 5), ("a", 4, 6), ("b", 5, 7), ("b", 8, 8), (None, 8, 9)],
        [("b", 6, 1), ("b", 7, 2), ("a", 8, 3), ("a", None, 0)],
    ]
    made = [[(q, None if day is None else DAY.format(day, hour)) for q, day, hour in part] for part in rows]
    return [spark.createDataFrame(part, "searched_query string, t string").select(
        "searched_query", F.col("t").cast("timestamp_ntz").alias("client_received_start_timestamp")) for part in made]


def test_counts_of_a_log_that_arrives(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    left_out = []
    for part in deliveries(spark):
        part.write.mode("append").parquet(source)
        left_out.append(count_requests(read_stream(spark, source, part.schema), out, state))
    got = {r["searched_query"]: r["search_query_counts"] for r in request_counts(spark, out, part.schema).collect()}
    # On the 5th the 3rd is over, less a day; on the 8th the 6th.
    assert got == {"a": 2 + 1 + 1 + 1, "b": 1 + 1 + 1 + 1, None: 1}
    assert left_out == [0, 1, 1]
    # A run without new rows changes nothing, and neither does a micro-batch written again.
    count_requests(read_stream(spark, source, part.schema), out, state)
    assert {r["searched_query"]: r["search_query_counts"] for r in request_counts(spark, out, part.schema).collect()} == got
    kept = {os.path.basename(p): spark.read.parquet(p).count() for p in glob.glob(f"{out}/batch=*")}
    assert len(kept) >= 3 and max(kept.values()) <= 4


def test_counts_of_a_log_in_time_are_those_of_the_table(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    logs = spark.range(200).select(
        (F.col("id") % 7).cast("string").alias("searched_query"), (F.col("id") % 3).cast("string").alias("countryName"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id % 50 as int))").alias("client_received_start_timestamp"),
    )
    logs.repartition(5).write.parquet(source)
    count_requests(read_stream(spark, source, logs.schema, files_per_batch=2), out, state, late="90 days")
    assert bag(request_counts(spark, out, logs.schema)) == bag(dedup_count(logs))


def test_rounds_over_an_empty_table(spark):
    rounds = retry_until_filled(pois(spark, 0), answers_from(spark))
    assert rounds.remaining == 0 and read_rounds(pois(spark, 0), rounds).count() == 0


def test_rounds_are_read_in_one_scan(spark):
    rounds = retry_until_filled(pois(spark), answers_from(spark), stop_when_idle=True)
    assert plan(read_rounds(pois(spark), rounds)).count("Scan parquet") == 2  # once in the tree, once in the details


def test_a_round_in_several_batches(spark):
    df = pois(spark, 40).repartition(4)
    rounds = retry_until_filled(df, answers_from(spark), stop_when_idle=True, files_per_batch=1)
    rows = {r["reference_id"]: (r["apiCalls"], r["apiResults"]) for r in read_rounds(df, rounds).collect()}
    assert rows == {i: (i % 3 + 1, [{"id": str(i)}]) if i % 5 else (4, None) for i in range(40)}


def even_names():
    """Makes a client that answers names with an even number."""

    def make():
        def ask(row):
            return [{"id": row["name"], "poi": {"name": row["name"]}}] if int(row["name"][1:]) % 2 == 0 else None

        return ask

    return make


def test_rounds_with_a_python_client(spark):
    rounds = retry_until_filled(pois(spark), client_filler(even_names(), ["name"]), max_rounds=2)
    rows = {r["reference_id"]: (r["apiCalls"], r["apiResults"]) for r in read_rounds(pois(spark), rounds).collect()}
    assert rows[0] == (1, [{"id": "p0", "poi": '{"name":"p0"}'}]) and rows[1] == (2, None)


def test_answered_rows_are_kept(spark):
    rows = start_unanswered(pois(spark, 4)).withColumns({
        "apiResults": F.when(F.col("reference_id") == 2, F.array(F.create_map(F.lit("id"), F.lit("old")))), "apiCalls": F.lit(3),
    })
    for filler in (answers_from(spark, 1), client_filler(even_names(), ["name"])):
        got = {r["reference_id"]: (r["apiCalls"], r["apiResults"]) for r in fill_if_null(rows, filler).collect()}
        assert got[2] == (3, [{"id": "old"}])
        assert got[0][0] == 4 and got[1][0] == 4
