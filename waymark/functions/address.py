"""Address components out of the two JSON-like text columns of a log row, and queries rebuilt from them.

The texts are matched by pattern, not parsed as JSON: doubled quotes are collapsed first, after which an
empty value runs into the next pair. That outcome is part of the contract.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.text import collapse_quotes, decode_escapes, squeeze_space, strip_space
from waymark.schemas import (
    ALL_ESCAPES, COMMA_PARTS, COMPONENT_COLUMNS, ESCAPES, FLAG_COLUMNS, SPACED_PARTS, STRUCTURED_COLUMNS,
    STRUCTURED_ENDPOINT,
)


def is_structured(method: str = "method_name") -> Column:
    return F.coalesce(F.col(method) == STRUCTURED_ENDPOINT, F.lit(False))


def component_value(text: Column, key: str) -> Column:
    """Value of `key`, '' where it is missing, NULL for NULL text.

    The byte search spares the pattern for keys a text does not hold, which is most of them.
    (?d) lets the dot stop at line feeds only.
    """
    opening = f'"{key}":"'
    return F.when(~text.contains(opening), F.lit("")).otherwise(
        F.regexp_extract(text, f'(?d){opening}(.+?)"[,}}]', 1)
    )


def component_values(text: Column, keys: Sequence[str]) -> Column:
    """Values of `keys` in one array.

    Twenty patterns side by side make a generated method too large for the JVM to compile; as a function
    over an array they stay out of it, at less than half the time.
    """
    return F.transform(F.array(text), lambda t: F.array(*[component_value(t, key) for key in keys]))[0]


def parse_components(df: DataFrame, column: str = "lib_postal_result") -> DataFrame:
    """Adds removed_air_quotes and the 19 component columns."""
    quoted = df.withColumn("removed_air_quotes", collapse_quotes(F.col(column)))
    parts = quoted.withColumn("_parts", component_values(F.col("removed_air_quotes"), list(COMPONENT_COLUMNS)))
    return parts.withColumns({
        name: F.col("_parts")[i] for i, name in enumerate(COMPONENT_COLUMNS.values())
    }).drop("_parts")


def parse_structured(df: DataFrame, column: str = "parsed_request_quertystring") -> DataFrame:
    """Overwrites eight components of structured requests; removed_air_quotes is replaced in every row."""
    quoted = df.withColumn("removed_air_quotes", collapse_quotes(F.col(column)))
    wanted = F.when(is_structured(), component_values(F.col("removed_air_quotes"), list(STRUCTURED_COLUMNS)))
    parts = quoted.withColumns({"_parts": wanted, "_structured": is_structured()})
    return parts.withColumns({
        name: F.when(F.col("_structured"), F.col("_parts")[i]).otherwise(F.col(name))
        for i, name in enumerate(STRUCTURED_COLUMNS.values())
    }).drop("_parts", "_structured")


def spaced_query(parts: Sequence[str] = SPACED_PARTS) -> Column:
    """Parts joined by spaces. The ends are stripped before %20 is decoded, so a leading %20 leaves a space."""
    joined = strip_space(F.concat_ws(" ", *[F.col(p) for p in parts]))
    return squeeze_space(F.replace(joined, F.lit("%20"), F.lit(" ")))


def comma_query(parts: Sequence[str] = COMMA_PARTS, escapes: Mapping[str, str] = ESCAPES) -> Column:
    """Non-empty parts, decoded, joined by a comma and a space; NULL where all are empty."""
    filled = F.filter(F.array(*[F.col(p) for p in parts]), lambda part: part != "")
    decoded = F.transform(filled, lambda part: decode_escapes(part, escapes))
    return F.when(F.size(filled) > 0, F.array_join(decoded, ", "))


def rebuild_queries(
    df: DataFrame, style: str = "commas", escapes: Mapping[str, str] = ALL_ESCAPES,
    parts: Sequence[str] = COMMA_PARTS,
) -> DataFrame:
    """searched_query of structured requests rebuilt from their components."""
    if style == "none":
        return df
    if style not in ("commas", "spaces"):
        raise ValueError(f"style must be 'commas', 'spaces' or 'none', not {style!r}")
    rebuilt = comma_query(parts, escapes) if style == "commas" else spaced_query()
    return df.withColumn("searched_query", F.when(is_structured(), rebuilt).otherwise(F.col("searched_query")))


def component_flags(df: DataFrame) -> DataFrame:
    """Adds one boolean per component: present unless NULL, empty, one space or the text False."""
    return df.withColumns({
        flag: F.coalesce(~F.col(name).isin("", "False", " "), F.lit(False)) for name, flag in FLAG_COLUMNS.items()
    })
