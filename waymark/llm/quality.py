"""Line-first cleaning: rules per line, failed lines removed, documents that lose too much text rejected.

The rules see a line and its neighbours, so a page's menus and notices go while its prose stays, also prose that was
wrapped: a line that is full, so that the next line's first word would not have fitted, goes on in the next one and has
that one's sentence end. A document is judged only by how much of it is left, and by the base rules on its length and
repetition.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import Work, map_slices, pick

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
LETTERS = UPPER + UPPER.lower()
SPACES = b" \t\n\r\x0b\x0c"
# A sentence may end in these, also behind quotation marks and brackets.
SENTENCE_ENDS = (".", "!", "?", ":", ";", "…", "。", "！", "？", "؟", "۔", "।", "॥")
CLOSING = " \t\n\r\x0b\x0c\"'”’»)]*"
# A short line that consists of these for the most part is a notice; prose may name them.
BOILERPLATE = re.compile(
    rb"all rights reserved|(?:licensed|released) under(?: the)?(?:[ -~]{0,60}licen[cs]e)?|terms of (?:use|service)|privacy policy"
    rb"|cookies?|lorem ipsum|javascript|subscribe|sign (?:in|up)|log ?in|click here|read more|share this|copyright",
    re.IGNORECASE,
)
SCHEMA = (
    "doc_id long, clean_text string, n_lines int, n_failed_lines int, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, kept_chars long, base_failed boolean, kept boolean"
)


@dataclass(frozen=True)
class LineRules:
    """Percentages and counts of the line rules; a line without a word never fails and never counts."""

    symbol_percent: int = 8
    bar_percent: int = 15
    shout_percent: int = 50
    upper_percent: int = 60
    upper_letters: int = 20
    unpunctuated_words: int = 8
    boilerplate_words: int = 15
    boilerplate_percent: int = 40
    menu_words: int = 4
    menu_lines: int = 4
    loss_percent: int = 50
    base_words: int = 50
    base_repeat_percent: int = 50

    def fails(self, line: bytes, ends: bool | None = None) -> bool:
        """By the line itself; `ends` tells whether its sentence ends, here or in the lines that it goes on in."""
        words = len(line.split())
        size = len(line)
        bars = line.count(b"|")
        if 100 * (size - len(line.translate(None, SYMBOLS))) > self.symbol_percent * size:
            return True
        if bars >= 2 and 100 * bars >= self.bar_percent * words:
            return True
        if 100 * line.count(b"!!") >= self.shout_percent * words:
            return True
        upper = size - len(line.translate(None, UPPER))
        if upper >= self.upper_letters and 100 * upper > self.upper_percent * (size - len(line.translate(None, LETTERS))):
            return True
        if words >= self.unpunctuated_words and not (ended(line) if ends is None else ends):
            return True
        return words <= self.boilerplate_words and 100 * sum(map(len, BOILERPLATE.findall(line))) >= self.boilerplate_percent * size

    def failures(self, lines: list[bytes]) -> list[bool]:
        """Of each line of a text, whether it fails by itself or stands in a menu: short lines without a sentence end in a row."""
        ends = sentence_ends(lines)
        out = [bool(line.strip()) and self.fails(line, end) for line, end in zip(lines, ends)]
        short = [not end and 0 < len(line.split()) <= self.menu_words for line, end in zip(lines, ends)]
        first = 0
        for at in range(len(lines) + 1):
            if at == len(lines) or not short[at]:
                if at - first >= self.menu_lines:
                    out[first:at] = [True] * (at - first)
                first = at + 1
        return out


def ended(line: bytes) -> bool:
    return line.decode().rstrip(CLOSING).endswith(SENTENCE_ENDS)


def sentence_ends(lines: list[bytes]) -> list[bool]:
    """Of each line, whether it has a sentence end or goes on in lines of which the last has one.

    A line without an end goes on when the next one has words and its first one would have made this line longer than
    both neighbours; a line without words counts as of length 0.
    """
    words = [line.split() for line in lines]
    sizes = [len(line.decode()) if own else 0 for line, own in zip(lines, words)]
    ends = [bool(own) and ended(line) for line, own in zip(lines, words)]
    for at in range(len(lines) - 2, -1, -1):
        if words[at] and not ends[at] and words[at + 1]:
            full = sizes[at] + 1 + len(words[at + 1][0].decode())
            ends[at] = full > max(sizes[at - 1] if at else 0, sizes[at + 1]) and ends[at + 1]
    return ends


def points(text: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def repeat_words(words: list[list[bytes]]) -> list[int]:
    """Of each text, the words inside 3-word windows that the text has at least twice."""
    sizes = np.array([len(w) for w in words], np.int64)
    if not sizes.sum():
        return [0] * len(words)
    ids: dict[bytes, int] = {}
    flat = np.fromiter((ids.setdefault(w, len(ids)) for text in words for w in text), np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(words)), sizes)
    starts = np.flatnonzero(text[:-2] == text[2:])
    # Word numbers of a slice stay below 2^31, so that pairs fit; pairs are numbered again before the third word joins.
    _, pairs = np.unique(flat[:-1] << 31 | flat[1:], return_inverse=True)
    keys = pairs[starts] << 31 | flat[starts + 2]
    _, windows = np.unique(keys, return_inverse=True)
    order = np.lexsort((text[starts], windows))
    same = (windows[order][1:] == windows[order][:-1]) & (text[starts][order][1:] == text[starts][order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    inside = np.zeros(len(flat), bool)
    for shift in range(3):
        inside[starts[order[twice]] + shift] = True
    return np.bincount(text, weights=inside, minlength=len(words)).astype(np.int64).tolist()


def clean_lines(docs: DataFrame, rules: LineRules | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The cleaned text and the counts behind it, one row per document.

    Map-only. Missing and empty texts have no words, so they fail the base rules and are not kept; their clean text is
    empty. Equal rows give equal rows, a missing id stays missing.
    """
    rules = rules or LineRules()

    def begin() -> Work:
        def work(ids: list, texts: list[bytes | None]) -> list:
            texts = [t or b"" for t in texts]
            words = [t.split() for t in texts]
            repeats = repeat_words(words)
            rows = []
            for doc, text, own, repeat in zip(ids, texts, words, repeats):
                lines = text.split(b"\n")
                seen: set[bytes] = set()
                good, duplicates, failed, kept_chars = [], 0, 0, 0
                for line, fails in zip(lines, rules.failures(lines)):
                    if not line.split():
                        good.append(line)
                        continue
                    again = line in seen
                    seen.add(line)
                    duplicates += again
                    if again or fails:
                        failed += 1
                    else:
                        good.append(line)
                        kept_chars += points(line.translate(None, SPACES))
                chars = points(text.translate(None, SPACES))
                base = len(own) < rules.base_words or 100 * repeat > rules.base_repeat_percent * len(own)
                kept = not base and 100 * (chars - kept_chars) <= rules.loss_percent * chars
                rows.append((
                    doc, b"\n".join(good).decode(), len(lines), failed, len(own), chars,
                    len(text) - len(text.translate(None, SYMBOLS)), duplicates, repeat, kept_chars, base, kept,
                ))
            return [list(column) for column in zip(*rows)]

        return work

    return map_slices(pick(docs, doc_id=id, text=text).select(F.col("doc_id").cast("long"), "text"), begin, SCHEMA)
