"""Rounds of enrichment until no row is left without a result."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.operators.filters import unanswered
from waymark.schemas import RESULT_LIST
from waymark.session import new_path
from waymark.sources.records import get_records, put_record
from waymark.streaming.sinks import read_saved, read_stream

MOST_ROUNDS = 1000

# Gives the rows, all without results, a column `found` for the round.
Filler = Callable[[DataFrame, int], DataFrame]


def start_unanswered(pois: DataFrame) -> DataFrame:
    """Rows before the first round: no result, no calls."""
    return pois.withColumns({"apiResults": F.lit(None).cast(RESULT_LIST), "apiCalls": F.lit(0)})


def fill_if_null(rows: DataFrame, fill: Filler, round_number: int = 1) -> DataFrame:
    """One step: rows without a result get the filler's and one more call, the others stay as they are."""
    filled = fill(rows, round_number)
    missing = unanswered()
    return filled.withColumns({
        "apiCalls": F.when(missing, F.col("apiCalls") + 1).otherwise(F.col("apiCalls")),
        "apiResults": F.when(missing, F.col("found")).otherwise(F.col("apiResults")),
    }).select(*rows.columns)


@dataclass
class Rounds:
    """The rounds made: their number, the rows still unanswered, and the folder that holds the rows of all rounds."""

    count: int
    remaining: int
    folder: str
    schema: T.StructType
    # Of each round its rows by status and calls.
    reports: list[list[tuple[int, int, int]]] = field(default_factory=list)


# Columns that the folders of a round's rows stand for.
PLACES = ("round", "batch", "api_status")


def retry_until_filled(
    pois: DataFrame, fill: Filler, max_rounds: int = MOST_ROUNDS, stop_when_idle: bool = False,
    files_per_batch: int | None = None, folder: str | None = None,
) -> Rounds:
    """Streams the unanswered rows through `fill`, round by round, until none is left.

    A round writes its answered and unanswered rows to partitions of its own, and the next round reads only
    the latter, so an answered row is written once and no round is computed twice. A micro-batch replaces its
    folder, so one that runs again leaves nothing behind. `stop_when_idle` ends after a round without a new
    answer, for a filler that would not answer later either. The rounds are kept in `folder`, by default a new
    one in the shared folder.

    A folder of a run that was broken off is gone on with: every whole round has a record, and in the round after
    them the micro-batches that ended are not asked again. `pois` is then not read.
    """
    spark = pois.sparkSession
    root = folder or new_path(spark, "rounds")
    first = start_unanswered(pois)
    schema = T.StructType([*first.schema.fields, *[T.StructField(name, T.IntegerType()) for name in PLACES]])
    whole = sorted((r["round"], r["report"]) for r in get_records(spark, f"{root}/rounds").values())
    if not whole:
        start = _save_batch(first, root, 0, 0)
        _end_round(spark, root, 0, [start])
        whole = [(0, [start])]
    reports = [[tuple(line) for line in report] for _, report in whole[1:]]
    rounds = Rounds(len(reports), _waiting(whole[-1][1]), root, schema, reports)
    while rounds.remaining and rounds.count < max_rounds and not (stop_when_idle and _idle(rounds)):
        number = rounds.count + 1
        before = read_stream(spark, f"{root}/rows/round={number - 1}", _without_round(schema), files_per_batch=files_per_batch)
        waiting = before.where(F.col("api_status") == 0).select(*first.columns)
        _run_round(fill_if_null(waiting, fill, number), root, number)
        batches = [r["lines"] for r in get_records(spark, f"{root}/batches/round={number}").values()]
        report = _summed([line for lines in batches for line in lines])
        _end_round(spark, root, number, report)
        rounds.reports.append(report)
        rounds.count, rounds.remaining = number, _waiting(report)
    return rounds


def _waiting(report: list) -> int:
    return sum(n for status, _, n in report if status == 0)


def _idle(rounds: Rounds) -> bool:
    """Whether the last round brought no answer."""
    return bool(rounds.reports) and not any(status == 1 for status, _, _ in rounds.reports[-1])


def _summed(lines: list) -> list[tuple[int, int, int]]:
    totals: dict[tuple[int, int], int] = {}
    for status, calls, n in lines:
        totals[status, calls] = totals.get((status, calls), 0) + n
    return sorted((*key, n) for key, n in totals.items())


def _without_round(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != "round"])


def _save_batch(rows: DataFrame, root: str, number: int, batch: int) -> tuple[int, int, int] | list[tuple[int, int, int]]:
    """Writes a micro-batch by status, and gives its rows by status and calls, counted by the write itself."""
    seen = Observation()
    marked = rows.withColumn("api_status", F.col("apiResults").isNotNull().cast("int"))
    # All rows of a round have made as many calls as there were rounds.
    marked = marked.observe(seen, F.sum("api_status").alias("answered"), F.count(F.lit(1)).alias("rows"))
    marked.write.mode("overwrite").partitionBy("api_status").parquet(f"{root}/rows/round={number}/batch={batch}")
    answered = seen.get["answered"] or 0
    lines = [(status, number, n) for status, n in ((0, seen.get["rows"] - answered), (1, answered)) if n]
    return lines if number else (0, 0, seen.get["rows"])


def _end_round(spark: SparkSession, root: str, number: int, report: list) -> None:
    put_record(spark, f"{root}/rounds", f"round-{number}", {"round": number, "report": report})


def _run_round(step: DataFrame, root: str, number: int) -> None:
    spark = step.sparkSession

    def save(rows: DataFrame, batch: int) -> None:
        # Should the run break off behind this record, the micro-batch is run again and replaces both.
        put_record(spark, f"{root}/batches/round={number}", f"batch-{batch}", {"lines": _save_batch(rows, root, number, batch)})

    stream = step.writeStream.foreachBatch(save).option("checkpointLocation", f"{root}/checkpoint={number}")
    stream.trigger(availableNow=True).start().awaitTermination()


def read_rounds(pois: DataFrame, rounds: Rounds) -> DataFrame:
    """Every row once: answered rows from the round that answered them, the others from the last round.

    All rounds are one table, partitioned by round, micro-batch and status.
    """
    last = (F.col("api_status") == 1) | (F.col("round") == rounds.count)
    return read_saved(pois.sparkSession, f"{rounds.folder}/rows", rounds.schema).where(last).drop(*PLACES)


def client_filler(
    make_client: Callable[[], Callable[[dict], list[dict] | None]], columns: list[str], in_flight: int = 1,
    failures: tuple[type[BaseException], ...] = (Exception,),
) -> Filler:
    """A filler that asks a Python client, made once per task and call in flight.

    The client gets the row's `columns` as a dict and gives a list of results, or None when it has no answer
    yet; nested values are kept as JSON text. Rows that have results are not asked for. Rows reach Python in
    Arrow batches; at most `in_flight` calls of a task run at a time, and answers go to their rows in any case. A call that fails with one of
    `failures` has no answer yet, so the row waits for the next round; any other ends the task.
    """
    if in_flight < 1:
        raise ValueError(f"in_flight must be at least 1, not {in_flight}")

    def fill(rows: DataFrame, number: int) -> DataFrame:
        asked = rows.withColumns({"apiResults": F.to_json("apiResults"), "found": F.lit(None).cast("string")})

        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own = threading.local()

            def call(row: dict) -> str | None:
                try:
                    if not hasattr(own, "client"):
                        own.client = make_client()
                    answer = own.client(row)
                except failures:
                    return None
                return None if answer is None else json.dumps(answer)

            with ThreadPoolExecutor(in_flight) as pool:
                for batch in batches:
                    waiting = batch["apiResults"].isna()
                    batch.loc[waiting, "found"] = list(pool.map(call, batch.loc[waiting, columns].to_dict("records")))
                    yield batch

        answered = asked.mapInPandas(ask, asked.schema)
        return answered.withColumns({c: F.from_json(c, RESULT_LIST) for c in ("apiResults", "found")})

    return fill
