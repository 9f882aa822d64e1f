from __future__ import annotations

import re
import textwrap
from collections import Counter

import pytest

from waymark.llm.quality import LineRules, clean_lines, repeat_words, sentence_ends
from waymark.llm.queries import op4_quality

WORD = "[^\x20\x09-\x0D]+"


def base(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = [False] * len(words)
    for i, window in enumerate(zip(words, words[1:], words[2:])):
        if windows[window] > 1:
            inside[i:i + 3] = [True] * 3
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(inside),
        len(words) < 50 or 100 * sum(inside) > 50 * len(words),
    )


def counted(row):
    return tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))


def test_base_counts_agree(both):
    rows = clean_lines(both).collect()
    assert Counter((r["doc_id"], *counted(r)) for r in rows) == Counter((r["doc_id"], *base(r["text"])) for r in both.collect())
    assert not any(r["kept"] for r in rows if r["base_failed"])


def test_query_keeps_good_and_rejects_bad_documents(spark, sf):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in op4_quality(spark, sf).collect() if not r["base_failed"] and r["doc_id"] in labels]
    assert sum(r["kept"] == (labels[r["doc_id"]] == 1) for r in rows) >= 0.97 * len(rows)


def test_no_rows(empty):
    assert clean_lines(empty).collect() == []


@pytest.mark.parametrize(("line", "fails"), [
    ("The cat sat on the mat, and the dog lay beside it.", False),
    ("Home | News | Sport | Contact", True),
    ("one### two$$$ three%%% four&&&", True),
    ("BUY!! NOW!! CHEAP!!", True),
    ("ALL OF THIS LINE IS WRITTEN IN CAPITALS.", True),
    ("this line of nine words has no sentence end", True),
    ("A short title", False),
    ("He said: \"this is the end of the story.\"", False),
    ("All rights reserved.", True),
    ("Released under the MIT License.", True),
    ("This work is licensed under the GNU General Public License, version 3.", True),
    ("Please enable JavaScript", True),
    ("She baked a cookie for her friend that day.", False),
    ("JavaScript is a programming language.", False),
    ("The film was released under another title in the north.", False),
    ("هل هذا سؤال من ثمانية كلمات أو أكثر بقليل؟", False),
    ("यह वाक्य आठ से अधिक शब्दों का है और पूरा है।", False),
    ("Jede Zeile mit mehr als acht Wörtern endet hier mit einem Punkt.", False),
])
def test_line_rules(line, fails):
    assert LineRules().fails(line.encode()) is fails


def test_lines_go_and_documents_that_lose_too_much(spark):
    prose = " ".join(f"word{i}" for i in range(60)) + "."
    menu = "Home | News | Sport | Contact | About | Search"
    rows = [(1, f"{menu}\n{prose}\n\n{prose}"), (2, "\n".join([f"{menu} | {i}" for i in range(40)])), (3, prose)]
    found = {r["doc_id"]: r for r in clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1]["clean_text"] == f"{prose}\n" and found[1]["n_failed_lines"] == 2
    assert [found[i]["kept"] for i in (1, 2, 3)] == [False, False, True]


def test_windows_do_not_cross_texts():
    assert repeat_words([[b"a", b"b"], [b"c", b"a", b"b", b"c"], [], [b"a"] * 4]) == [0, 0, 0, 4]


@pytest.mark.parametrize("columns", [40, 72, 100])
def test_wrapped_prose_stays(spark, documents, columns):
    kept = {r["doc_id"] for r in clean_lines(documents).where("kept").collect()}

    def wrapped(text):
        return "\n".join(textwrap.fill(line, columns, break_long_words=False, break_on_hyphens=False) for line in text.split("\n"))

    rows = [(r["doc_id"], wrapped(r["text"])) for r in documents.where("text is not null").collect() if r["doc_id"] in kept]
    again = clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).where("kept").count()
    assert again >= 0.95 * len(rows) > 0


@pytest.mark.parametrize(("text", "ends"), [
    ("", [False]),
    ("one two three\nfour.", [True, True]),
    ("one two three\n\nfour.", [False, False, True]),
    ("one\ntwo three four five six seven.", [False, True]),
    ("a long line before this one.\nshort\nend.", [True, False, True]),
    ("one two three\nfour five six", [False, False]),
    ("one two three.\nfour five six\nseven eight.", [True, True, True]),
])
def test_lines_that_go_on(text, ends):
    assert sentence_ends(text.encode().split(b"\n")) == ends


def test_menus_of_short_lines():
    prose = b"The weather was fine, and so the whole village went out to the lake for the day."
    menu = [b"Home", b"Previous Next", b"Skip to content", b"Share on Facebook Tweet"]
    assert LineRules().failures([prose, *menu, prose]) == [False, True, True, True, True, False]
    assert LineRules().failures([prose, *menu[:3], prose]) == [False] * 5
    assert LineRules().failures([menu[0], b"", *menu[1:]]) == [False] * 5
    assert LineRules().failures(menu * 2) == [True] * 8


def test_clashing_columns(edge):
    rows = clean_lines(edge).collect()
    assert Counter((r["doc_id"], *counted(r)) for r in rows) == Counter((r["doc_id"], *base(r["text"])) for r in edge.collect())
