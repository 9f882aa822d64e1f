"""Samples of a log per country."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.text import row_hash
from waymark.operators import filters as f
from waymark.operators.backfill import adaptive_backfill
from waymark.operators.dedup import COUNT, dedup_count, present_keys
from waymark.operators.dimensions import decode_fields, match_countries
from waymark.operators.joins import BROADCAST_ROWS
from waymark.operators.ordering import row_index
from waymark.operators.ranking import check_size, first_n, random_sample
from waymark.schemas import POI_ENDPOINT


def sample_name(only_full_addresses: bool, run_date: dt.date) -> str:
    """Name a sample is saved under, before the country."""
    return f"{'' if only_full_addresses else 'in'}complete_responses_{run_date:%d-%m-%Y}"


def select_logs(
    logs: DataFrame, spellings: DataFrame, countries: f.Names, endpoints: f.Names = None,
    exclude_endpoints: f.Names = POI_ENDPOINT, developer_emails: f.Names = None, populated_fields: f.Names = None,
    only_full_addresses: bool = True,
) -> DataFrame:
    """Rows of the countries that pass all filters but the time, with `country`."""
    kept = logs.where(
        f.full_addresses(only_full_addresses)
        & f.named("method_name", endpoints, "endpoints")
        & f.not_named("method_name", exclude_endpoints, "exclude_endpoints")
        & f.with_populated_fields(populated_fields)
    )
    if "developer_email" in logs.columns:
        kept = kept.where(f.not_named("developer_email", developer_emails, "developer_emails"))
    return match_countries(kept, spellings, countries)


def country_count(spellings: DataFrame, countries: f.Names = None) -> int:
    """How many countries a match can give, counted in the spellings."""
    codes = f.as_names(countries, "countries")
    return spellings.select("country_code").distinct().count() if codes is None else len(codes)


def finish_sample(sample: DataFrame, fields: DataFrame) -> DataFrame:
    """Decoded fields, upper-case country names, a developer_email column, and no broken text."""
    decoded = decode_fields(sample, fields).withColumn("countryName", F.upper("countryName"))
    if "developer_email" not in decoded.columns:
        decoded = decoded.withColumn("developer_email", F.lit(""))
    return decoded.where(f.readable())


def most_repeated(chosen: DataFrame, sample: int | None, groups: int) -> DataFrame:
    """The `sample` most repeated requests of each country with their counts.

    Requests are counted and ranked by a digest of 16 bytes of their keys, which is also what orders ties; only rows whose digest
    is drawn are then shuffled with all their columns. They are grouped by the keys themselves, so requests that share a digest
    are rows of their own. Where more digests are drawn than may be broadcast, whole requests are counted at once.
    """
    keys = present_keys(chosen)
    if sample is None or not 0 < sample * groups <= BROADCAST_ROWS:
        return first_n(dedup_count(chosen, ["country"]), sample, ["country"], count=COUNT, tie_columns=keys, groups=groups)
    digested = chosen.withColumn("_digest", row_hash(keys))
    counts = digested.groupBy("country", "_digest").agg(F.count(F.lit(1)).alias(COUNT))
    drawn = first_n(counts, sample, ["country"], count=COUNT, hashed="_digest", groups=groups).select("country", "_digest")
    return dedup_count(digested.join(F.broadcast(drawn), ["country", "_digest"], "left_semi"), ["country"])


def sample_logs(
    logs: DataFrame, spellings: DataFrame, fields: DataFrame, now: str | dt.datetime,
    countries: f.Names = None, sample: int | None = 10_000, ago: int | str | None = 365,
    deduplicate: bool = True, pre_cap: int | None = None, id_columns: Sequence[str] | None = None, seed: int = 0,
    **selection,
) -> DataFrame:
    """The `sample` most repeated requests of every country, or as many random rows without `deduplicate`.

    All countries are sampled in one pass. `pre_cap` takes that many rows of each country before they are
    deduplicated. `selection` goes to `select_logs`.
    """
    check_size(sample)
    check_size(pre_cap, "pre_cap")
    chosen = select_logs(logs.where(f.looked_back(now, ago)), spellings, countries, **selection)
    groups = country_count(spellings, countries)
    if pre_cap is not None:
        chosen = random_sample(chosen, pre_cap, seed, ["country"], id_columns, groups)
    if deduplicate:
        drawn = most_repeated(chosen, sample, groups)
    else:
        drawn = random_sample(chosen, sample, seed, ["country"], id_columns, groups)
    return finish_sample(drawn, fields)


def backfill_logs(
    logs: DataFrame, spellings: DataFrame, fields: DataFrame, now: str | dt.datetime,
    countries: f.Names = None, sample: int = 10_000, ago: int | str = 365, deduplicate: bool = True,
    id_columns: Sequence[str] | None = None, seed: int = 0, day: str | None = None, **selection,
) -> DataFrame:
    """The sample of every country gathered from date windows, newest first: the most repeated requests of each
    window, or random rows without `deduplicate`. `day` is the log's partition column of dates, if it has one."""
    chosen = select_logs(logs, spellings, countries, **selection)
    groups = country_count(spellings, countries)
    drawn = adaptive_backfill(chosen, now, sample, ago, groups, deduplicate=deduplicate, id_columns=id_columns, seed=seed, day=day)
    return finish_sample(drawn.drop(day) if day in drawn.columns else drawn, fields)


def ranked_sample(sample: DataFrame) -> DataFrame:
    """A sample in its order, most repeated requests first, with that order as `rank` from 1.

    Equal counts follow each other by country and log keys. The table is ordered by range partitions.
    """
    numbered = row_index(sample, [F.desc(COUNT), *present_keys(sample, ["country"])], to="rank")
    return numbered.withColumn("rank", F.col("rank") + 1)
