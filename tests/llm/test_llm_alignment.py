from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from waymark.llm import alignment
from waymark.llm.alignment import Memo, Tokenizers, align_tokenizers, aligned_spans, group_texts, read_model, refined, text_digest
from waymark.llm.common import pick
from waymark.llm.queries import op11_alignment
from waymark.llm.token_counts import byte_symbols, read_vocabulary

TEXTS = [
    " lead", "trail ", "a  b", "\n\n", " ", "a \n b", "é日ሴ\U0001F600 กሴ x", "a▁b c", "▁", "<s> </s> <unk> <0x41> <|endoftext|>", "x" * 3000,
    "日本語のテキスト" * 300, "a\xa0b \xa0 c", "a\tb\r\nc", "tab \t end", "\x1c y \x85z", "don't  stop", "ﬁ É é ½", "\x00 a", "a​b", "word\n\nword",
]


class Plain:
    """Both libraries on whole texts, tokens' bytes laid end to end."""

    def __init__(self):
        path = public_tokenizers.path("byte_bpe_50k.json")
        self.a = Tokenizer.from_file(path)
        self.a.encode_special_tokens = True
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        self.a_bytes = {i: bytes(byte_of[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def groups(self, text):
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text, return_type=int)
        a_bytes = [self.a_bytes[i] for i in a]
        b_bytes = []
        for i in b:
            piece = self.b.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        whole = (" " + text).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return []
        ends = [np.cumsum(list(map(len, t))).tolist() for t in (a_bytes, b_bytes)]
        out, past = [], [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            stop = [own.index(cut, p) + 1 for own, p in zip(ends, past)]
            out.append(tuple(ids[p:q] for ids, p, q in zip((a, b), past, stop)))
            past = stop
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def digest(groups):
    text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
    return hashlib.sha256(text.encode()).hexdigest() if groups else ""


def want(rows, plain):
    groups = [(r["doc_id"], plain.groups(r["text"])) for r in rows]
    counts = Counter((a[-1], b[-1]) for _, own in groups for a, b in own)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = Counter()
    for doc, own in groups:
        links = [(a[-1], b[-1]) for a, b in own]
        best = sum(counts[link] == most[link[1]] for link in links)
        sizes = sum(len(a) for a, _ in own), sum(len(b) for _, b in own)
        out[doc, *sizes, len(own), len(links), best, sum(counts[link] for link in links), digest(own)] += 1
    return out


def have(df, last):
    return Counter(tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", last).collect())


@pytest.fixture(scope="module")
def odd(spark, edge):
    rows = spark.createDataFrame([(5000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    return edge.select("doc_id", "text").unionByName(rows)


def test_query_against_whole_texts(spark, sf, documents, plain):
    assert have(op11_alignment(spark, sf), "groups_sha256") == want(documents.collect(), plain)


def test_odd_texts_with_few_known_pairs(odd, plain):
    found = align_tokenizers(odd, groups=text_digest, head=5)
    assert have(found, "groups") == want(odd.collect(), plain)


def test_no_known_pairs_and_a_memo_that_begins_anew(spark, documents, plain, monkeypatch):
    monkeypatch.setattr(alignment, "MEMO_WORDS", 50)
    some = documents.where("doc_id < 40")
    assert have(align_tokenizers(some, groups=text_digest, head=0), "groups") == want(some.collect(), plain)


def test_clashing_columns_and_no_rows(edge, empty, plain):
    assert have(align_tokenizers(edge, groups=text_digest), "groups") == want(pick(edge, doc_id="doc_id", text="text").collect(), plain)
    assert align_tokenizers(empty).collect() == []


def test_rows_without_tokens(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "a▁b"), (None, "")], "doc_id long, text string")
    assert all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in align_tokenizers(rows).collect())


_own: list = []


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t.a1é日\xa0▁<"), st.characters(codec="utf-8", exclude_categories=("Cs",))), max_size=40))
def test_any_text_like_the_whole(text):
    if not _own:
        tokenizers = Tokenizers(read_vocabulary(None, "byte_bpe_50k.json"), read_model(None, "piece_bpe_32k.model"))
        assert tokenizers.by_word
        _own.extend([tokenizers, Memo(tokenizers), Plain()])
    tokenizers, memo, whole = _own
    sizes, texts, (pairs, times, bounds) = memo.gather([tokenizers.words(text) if text else []])
    groups = whole.groups(text)
    assert sizes[:, 0].tolist() == [sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups)]
    assert texts == [";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)]
    links = Counter(x[-1] << 20 | y[-1] for x, y in groups)
    assert dict(zip(pairs.tolist(), times.tolist())) == links and bounds.tolist() == [0, len(links)]


def test_spans(odd, plain):
    for row, text in zip(aligned_spans(odd).collect(), [r["text"] for r in odd.collect()]):
        groups = plain.groups(text)
        assert [(g["a_ids"], g["b_ids"]) for g in row["groups"]] == groups
        assert [g["first"] for g in row["groups"]] == [0, *[g["past"] for g in row["groups"]]][:len(groups)]
        assert not groups or row["groups"][-1]["past"] == len(text.encode()) + 1


def test_spans_of_sentencepiece_come_as_offsets(plain, monkeypatch):
    # Its proto costs an object per token.
    tokenizers = Tokenizers(read_vocabulary(None, "byte_bpe_50k.json"), read_model(None, "piece_bpe_32k.model"))
    kinds, own = set(), tokenizers.b

    class Asked:
        def encode(self, text, return_type):
            kinds.add(return_type)
            return own.encode(text, return_type=return_type)

    monkeypatch.setattr(tokenizers, "b", Asked())
    for text in filter(None, TEXTS):
        made = tokenizers.encode(text)
        groups = plain.groups(text)
        have_ids = ([], []) if made is None else (made[0].tolist(), made[2].tolist())
        assert have_ids == tuple([i for g in groups for i in g[n]] for n in (0, 1))
    assert kinds == {"offset_mapping"}


def test_white_space_beside_blanks():
    tokenizers = Tokenizers(read_vocabulary(None, "byte_bpe_50k.json"), read_model(None, "piece_bpe_32k.model"))
    for text in [*TEXTS, "a\n\nb c", "a \xa0b c", "\na b\n", " a b", "a b "]:
        assert tokenizers.words(text) == alignment.BETWEEN.split(text)


def test_group_text():
    a, b, a_sizes, b_sizes = map(np.array, ([1, 2, 3, 7], [4, 5, 6, 8], [2, 1, 1], [1, 2, 1]))
    assert group_texts(a, b, a_sizes, b_sizes, np.array([1, 2])) == ["1,2|4;3|5,6", "7|8"]


def test_spans_that_share_a_character_are_refined():
    # The second character has three bytes in three tokens, all with its span; the last token's span leaves out two blanks.
    assert refined(np.array([1, 4, 4, 4, 6, 7]), np.array([1, 1, 1, 1, 2, 3])).tolist() == [1, 2, 3, 4, 6, 9]
