"""Country spellings and coded field names as dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions.text import pipe_items
from waymark.operators.filters import Names, as_names
from waymark.operators.joins import dimension_join, fits_broadcast, salted_join
from waymark.session import saved

# Field names kept as a literal map; a larger list is joined.
LITERAL_FIELDS = 512


def spelling_pairs(spellings: DataFrame) -> DataFrame:
    """(country_code, spelling) pairs without repeats, from pairs or from one array per country."""
    if isinstance(spellings.schema["spelling" if "spelling" in spellings.columns else "spellings"].dataType, T.ArrayType):
        spellings = spellings.select("country_code", F.explode("spellings").alias("spelling"))
    return spellings.select("country_code", "spelling").distinct()


def spelling_sets(names: DataFrame, codes: DataFrame, languages: Sequence[str] | None = None) -> DataFrame:
    """One sorted array of spellings per country: its names in the languages, by default all with two-letter
    codes, its two codes, and its official name where it has one.

    `names` holds (country_code, language, name), `codes` (country_code, iso3, official_name). A country has
    a few hundred distinct spellings at most; repeats are dropped before they are put together.
    """
    spoken = F.length("language") == 2 if languages is None else F.col("language").isin(list(languages))
    own = F.explode(F.array(F.upper("country_code"), F.col("iso3"), F.col("official_name"))).alias("spelling")
    pairs = names.where(spoken).select("country_code", F.col("name").alias("spelling")).union(codes.select("country_code", own))
    return pairs.where(F.col("spelling").isNotNull()).distinct().groupBy("country_code").agg(
        F.array_sort(F.collect_list("spelling")).alias("spellings")
    )


def _lowered(spellings: DataFrame, countries: Names) -> DataFrame:
    pairs = spelling_pairs(spellings)
    codes = as_names(countries, "countries")
    if codes is not None:
        pairs = pairs.where(F.upper("country_code").isin([c.upper() for c in codes]))
    return pairs.select(F.lower("spelling").alias("_spelling"), "country_code").distinct()


def match_countries(logs: DataFrame, spellings: DataFrame, countries: Names = None) -> DataFrame:
    """Logs with `country`, the code their countryName spells; a spelling of two codes gives two rows."""
    dimension = _lowered(spellings, countries).withColumnRenamed("country_code", "country")
    named = logs.withColumn("_spelling", F.lower("countryName"))
    return dimension_join(named, dimension, ["_spelling"]).drop("_spelling")


def in_countries(logs: DataFrame, spellings: DataFrame, countries: Names = None) -> DataFrame:
    """Logs whose countryName spells one of the countries, each once."""
    dimension = _lowered(spellings, countries).select("_spelling").distinct()
    named = logs.withColumn("_spelling", F.lower("countryName"))
    return dimension_join(named, dimension, ["_spelling"], "left_semi").drop("_spelling")


def country_to_iso2(df: DataFrame, spellings: DataFrame, column: str, to: str = "iso2") -> DataFrame:
    """Adds the code a country name stands for, 'not found' where there is none; the least code wins."""
    codes = _lowered(spellings, None).groupBy("_spelling").agg(F.min("country_code").alias("_code"))
    named = df.withColumn("_spelling", F.lower(F.col(column)))
    return (
        dimension_join(named, codes, ["_spelling"], "left")
        .withColumn(to, F.coalesce(F.col("_code"), F.lit("not found")))
        .drop("_spelling", "_code")
    )


def iso2_codes(countries: Sequence[str] | str, spellings: DataFrame) -> list[str]:
    """The codes of one or several country names, in their order."""
    named = [countries] if isinstance(countries, str) else list(countries)
    asked = spellings.sparkSession.createDataFrame(list(enumerate(named)), "position int, name string")
    return [row["iso2"] for row in country_to_iso2(asked, spellings, "name").orderBy("position").collect()]


def _unknown(item: Column) -> Column:
    return F.raise_error(F.concat(F.lit("unknown populated field: "), item)).cast("string")


def _fields(fields: DataFrame) -> DataFrame:
    """One name per id; an id with two different names fails, whatever the size of the table."""
    named = fields.groupBy(F.col("populated_field_id").cast("string").alias("_id")).agg(
        F.min("populated_field_description").alias("_name"), F.max("populated_field_description").alias("_other")
    )
    unclear = F.raise_error(F.concat(F.lit("populated field with two names: "), F.col("_id"))).cast("string")
    return named.select("_id", F.when(F.col("_name") != F.col("_other"), unclear).otherwise(F.col("_name")).alias("_name"))


def decode_fields(df: DataFrame, fields: DataFrame, strict: bool = True) -> DataFrame:
    """Adds `components`, the names of the coded populated_fields joined by a pipe, and `number_components`.

    An unknown id fails when `strict`, else it is left out; an id with two names always fails. The names are a literal
    map in the plan as long as there are few of them; a larger table goes to `decode_fields_join`, with equal results.
    """
    rows = _fields(fields).limit(LITERAL_FIELDS + 1).collect()
    if not rows or len(rows) > LITERAL_FIELDS:
        return decode_fields_join(df, fields, strict)
    names = F.create_map(*[F.lit(v) for row in rows for v in (row["_id"], row["_name"])])

    def decoded(item: Column) -> Column:
        return F.coalesce(names[item], _unknown(item)) if strict else names[item]

    items = F.transform(pipe_items(F.col("populated_fields")), decoded)
    found = items if strict else F.filter(items, lambda name: name.isNotNull())
    return df.withColumn("_names", found).withColumns({
        "components": F.array_join("_names", "|"),
        "number_components": F.size("_names"),
    }).drop("_names")


def decode_fields_join(
    df: DataFrame, fields: DataFrame, strict: bool = True, spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """As `decode_fields`, for any number of field names.

    Each distinct list is decoded once: its items meet the names in a join and are put together again in
    their order. The logs then look their list up: broadcast while the measured lists allow it, else with hot lists (such as the empty one) apart.
    """
    counted = df.where(F.col("populated_fields").isNotNull()).groupBy("populated_fields").agg(F.count(F.lit(1)).alias("_rows"))
    # Counted once; a stream's lists cannot be.
    lists = counted if df.isStreaming else saved(counted, "coded-lists")
    items = lists.select(
        "populated_fields", F.posexplode_outer(pipe_items(F.col("populated_fields"))).alias("_pos", "_id")
    )
    named = dimension_join(items, _fields(fields), ["_id"], "left")
    if strict:
        unknown = F.col("_id").isNotNull() & F.col("_name").isNull()
        named = named.withColumn("_name", F.when(unknown, _unknown(F.col("_id"))).otherwise(F.col("_name")))
    ordered = F.array_sort(F.collect_list(F.when(F.col("_name").isNotNull(), F.struct("_pos", "_name"))))
    decoded = named.groupBy("populated_fields").agg(F.transform(ordered, lambda item: item["_name"]).alias("_names"))
    lookup = decoded.select(
        "populated_fields", F.array_join("_names", "|").alias("components"), F.size("_names").alias("number_components")
    )
    if not df.isStreaming and fits_broadcast(lists):
        return df.join(F.broadcast(lookup), "populated_fields", "left")
    return salted_join(df, lookup, ["populated_fields"], "left", lists, spread_by)
