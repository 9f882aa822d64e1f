"""Column expressions on text: escapes, white space, pipe lists, request paths, dates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: white space as Python counts it (Unicode white space and the four separators).
SPACE = r"[\s\x1c-\x1f]"


def collapse_quotes(text: Column) -> Column:
    """Runs of single quotes, then runs of double quotes, cut down to one. Texts without runs are left alone."""
    for quote in ("'", '"'):
        text = F.when(text.contains(quote * 2), F.regexp_replace(text, f"{quote}+", quote)).otherwise(text)
    return text


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)^{SPACE}+|{SPACE}+$", "")


def squeeze_space(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U){SPACE}+", " ")


def decode_escapes(text: Column, escapes: Mapping[str, str]) -> Column:
    """Literal, case-sensitive replacements in the order of `escapes`; not a general URL decoder."""
    for escape, plain in escapes.items():
        text = F.replace(text, F.lit(escape), F.lit(plain))
    return text


def strip_underscores(text: Column) -> Column:
    return F.regexp_replace(text, "^_+", "")


def rename_without_underscores(df: DataFrame) -> DataFrame:
    """Every column renamed to its name without leading underscores."""
    names = [name.lstrip("_") for name in df.columns]
    if len(set(names)) < len(names) or "" in names:
        raise ValueError(f"column names clash without their underscores: {df.columns}")
    return df.toDF(*names)


def pipe_items(text: Column) -> Column:
    """Items of a pipe list without the empty ones."""
    return F.filter(F.split(text, "[|]"), lambda item: item != "")


def percent_encode(text: Column) -> Column:
    """Percent encoding that leaves only letters, digits and `_.-~` as they are."""
    form = F.url_encode(text)
    for made, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        form = F.replace(form, F.lit(made), F.lit(wanted))
    return form


def geocode_url(query: Column, country: Column, host: str, kr_host: str, limit: int = 50) -> Column:
    """Address of a geocode request, without a key; requests for `kr` go to a host of their own."""
    base = F.when(country == "kr", F.lit(kr_host)).otherwise(F.lit(host))
    return F.concat(base, F.lit("/search/2/geocode/"), percent_encode(query), F.lit(f".json?limit={limit}"))


def reverse_url(lat: Column, lon: Column, country: Column, host: str, kr_host: str, limit: int = 50) -> Column:
    base = F.when(country == "kr", F.lit(kr_host)).otherwise(F.lit(host))
    point = F.concat(lat.cast("string"), F.lit("%2C"), lon.cast("string"))
    return F.concat(base, F.lit("/search/2/reverseGeocode/"), point, F.lit(f".json?limit={limit}"))


def poi_url(name: Column, lat: Column, lon: Column, radius: Column, host: str, limit: int = 50) -> Column:
    return F.concat(
        F.lit(f"{host}/search/2/poiSearch/"), percent_encode(name),
        F.lit(f".json?limit={limit}&openingHours=nextSevenDays&relatedPois=all&lat="), lat.cast("string"),
        F.lit("&lon="), lon.cast("string"), F.lit("&radius="), radius.cast("string"),
    )


def parse_dmy(text: Column) -> Column:
    """Date from day/month/year text."""
    return F.to_date(text, "d/M/yyyy")


def run_label(date: Column) -> Column:
    """Date as it stands in the names of saved files."""
    return F.date_format(date, "dd-MM-yyyy")


def row_hash(columns: list[str], *extra: str) -> Column:
    """md5 of the columns and of `extra`; the same text in any SQL engine."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]
    return F.md5(F.concat_ws("|", *parts, *[F.lit(e) for e in extra]))
