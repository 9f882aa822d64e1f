"""The registered SQL against the queries, on the generated tables and on odd rows."""

from __future__ import annotations

import textwrap
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

from waymark.llm.decontamination import find_benchmark, items_digest
from waymark.llm.ngram_join import similar_groups
from waymark.llm.quality import clean_lines
from waymark.llm.queries import ORACLES, QUERIES

ITEMS = [(1, "the cat sat"), (2, "le chat et le chien le chat et le chien le chat et le chien le chat et le chien"), (3, None), (2, "La TABLE, de")]


def agree(df, sql, connection):
    expected = connection.sql(sql)
    columns = sorted(df.columns)
    assert sorted(expected.columns) == columns
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: kinds[df.schema[c].dataType.simpleString()] for c in columns} == {c: types[c] for c in columns}
    places = [expected.columns.index(c) for c in columns]
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == Counter(tuple(r[i] for i in places) for r in expected.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, sf, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    agree(QUERIES[name](spark, sf), ORACLES[name], connection)


def test_odd_rows_agree_with_sql(spark, both):
    rows = both.where("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text")
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    connection = duckdb.connect()
    connection.register("documents", pa.Table.from_pylist([r.asDict() for r in rows.collect()], pa.schema([("doc_id", pa.int64()), ("text", pa.string())])))
    connection.register("benchmark", pa.table({"item_id": [i for i, _ in ITEMS], "text": [t for _, t in ITEMS]}))
    agree(clean_lines(rows).drop("clean_text"), ORACLES["op4_quality"], connection)
    agree(similar_groups(rows, 3, 90).drop("class_id"), ORACLES["op1_ngram_join"], connection)
    found = find_benchmark(rows, spark.createDataFrame(ITEMS, "item_id long, text string"))
    agree(found.select("doc_id", "n_words", "n_hit", *items_digest(), "contaminated"), ORACLES["op6_decontamination"], connection)


def test_wrapped_texts_and_menus_agree_with_sql(spark, documents):
    """Lines of many widths, with menus and notices between them."""
    menu = ["Home", "Previous Next", "Skip to content", "Share on Facebook Tweet", "", "Zurück", "licensed under the MIT Licence", "She baked a cookie."]
    rows = []
    for i, r in enumerate(documents.where("length(text) > 200").orderBy("doc_id", "text").limit(150).collect()):
        lines = [line for part in r["text"].split("\n") for line in textwrap.wrap(part, 15 + i)]
        for at in range(0, len(lines), 7 + i % 5):
            lines[at:at] = menu[:i % len(menu) + 1]
        rows.append((i, "\n".join(lines)))
    connection = duckdb.connect()
    connection.register("documents", pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}))
    agree(clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).drop("clean_text"), ORACLES["op4_quality"], connection)
