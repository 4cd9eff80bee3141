"""Alignment against a plain reading of its definition on whole texts."""

import hashlib
import random
from bisect import bisect_right
from collections import Counter, defaultdict

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from supplierlens.llm import alignment
from supplierlens.llm.common import documents
from supplierlens.llm.registry import op11_alignment
from supplierlens.llm.tokens import BYTE_LETTERS, tokenizer_path
from tests.llm.conftest import cases

BYTE, PIECE = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
PARTS = ["a", "e", "the", "ing", "'s", "'", " ", "\n", "  ", "É", "ß", "1", "23", "!", "...", "–", "Σ", "\t", "İ", "<|endoftext|>",
         "漢", "\r\n", "ſ", "\xa0", "\x1c", "_", "Q", "x" * 40, "▁", "<s>", "<0x41>", "\0", " ", "\U0001f600", "ĳ", "×", "\n\n"]
_BYTE_OF = {c: b for b, c in BYTE_LETTERS.items()}


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE)


def tokens_of(libraries, text):
    """(A's ids and bytes, B's ids and bytes) of the whole text, none if the bytes differ."""
    a, b = libraries
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(_BYTE_OF[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    return list(zip(ids_a, bytes_a, strict=True)), list(zip(ids_b, bytes_b, strict=True))


def by_hand(libraries, texts):
    """Per text: n_a, n_b, n_groups, n_links, groups, n_best, count_sum."""
    found = []
    for text in texts:
        got = tokens_of(libraries, text)
        if got is None:
            found.append(None)
            continue
        spans = []
        for side in got:
            at, out = 0, []
            for i, x in side:
                out.append((at, at + len(x), i))
                at += len(x)
            spans.append(out)
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = ";".join("|".join(",".join(str(i) for _, _, i in side[bisect_right(side, lo, key=lambda x: x[1]):
                                                                       bisect_right(side, hi, key=lambda x: x[1])])
                                   for side in spans) for lo, hi in zip([0, *ends], ends, strict=False))
        links, j = [], 0
        for s, e, i in spans[0]:
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((i, spans[1][k][2]))
                k += 1
        found.append((len(got[0]), len(got[1]), len(ends), links, groups))
    count = Counter(p for x in found if x for p in set(x[3]))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [(0, 0, 0, 0, "", 0, 0) if x is None else
            (*x[:3], len(x[3]), x[4], sum(count[p] == best[p[0]] for p in x[3]), sum(count[p] for p in x[3])) for x in found]


def rows_of(out):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in out.collect())


def test_all_columns(docs, libraries, monkeypatch):
    rows = cases()
    want = Counter((r[0], *x) for r, x in zip(rows, by_hand(libraries, [r[1] for r in rows]), strict=True))
    assert rows_of(alignment.align(docs, BYTE, PIECE)) == want


def test_query(spark, corpus, libraries):
    rows = documents(spark, corpus).select("doc_id", "text").collect()
    want = {(r[0], *x[:4], hashlib.sha256(x[4].encode()).hexdigest() if x[4] else "", *x[5:])
            for r, x in zip(rows, by_hand(libraries, [r[1] for r in rows]), strict=True)}
    out = op11_alignment(spark, corpus)
    got = out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum").collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == want


def check_texts(own, libraries, texts):
    numbers, groups = own.over(texts)
    sizes, text, pair, weight = own.measured(numbers)
    for k, want in enumerate(by_hand(libraries, texts)):
        assert groups[k] == want[4], texts[k]
        assert tuple(sizes[k]) == want[:4]
        assert weight[text == k].sum() == want[3]


def test_odd_texts_and_a_small_table(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "TABLE_BYTES", 20_000)
    own, rnd = alignment.Aligner(BYTE, PIECE), random.Random(5)
    for _ in range(30):
        check_texts(own, libraries, ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 60))) for _ in range(20)])


_OWN: list = []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=30).map("".join) | st.text(max_size=30), max_size=4))
def test_any_texts(texts):
    if not _OWN:
        a = Tokenizer.from_file(BYTE)
        a.encode_special_tokens = True
        _OWN.extend([alignment.Aligner(BYTE, PIECE), (a, sentencepiece.SentencePieceProcessor(model_file=PIECE))])
    check_texts(_OWN[0], _OWN[1], [t for t in texts if not any(0xD800 <= ord(c) < 0xE000 for c in t)])


def test_components_of_long_chains():
    import numpy as np

    # Ends of A at even, of B at odd bytes meet only at the last one.
    ends_a, ends_b = np.append(np.arange(2, 4000, 2), 4001), np.append(np.arange(1, 4000, 2), 4001)
    assert (alignment.component_of(ends_a, ends_b) == len(ends_b) - 1).all()


def test_blocks_change_nothing(docs, monkeypatch):
    whole = rows_of(alignment.align(docs, BYTE, PIECE))
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 1)
    assert rows_of(alignment.align(docs.coalesce(1), BYTE, PIECE)) == whole


def test_empty_table(empty):
    assert alignment.align(empty, BYTE, PIECE).collect() == []
