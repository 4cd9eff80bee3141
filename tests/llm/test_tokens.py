"""Token operators against the tokenizers library on whole texts."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from supplierlens.llm import bpe, packing, token_counts, token_files, tokens
from supplierlens.llm.common import documents
from supplierlens.session import work_folder
from tests.llm.conftest import cases

BYTE, WORD = (tokens.tokenizer_path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = ["a", "e", "the", "ing", "'s", "'", " ", "\n", "  ", "É", "ß", "1", "23", "!", "...", "–", "Σ", "́",
         "\t", "İ", "<|endoftext|>", "漢", "\r\n", "ſ", "K", "\xa0", "\x1c", "_", "Q", "x" * 40]


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}


def ids_of(library, path, texts):
    return [x.ids for x in library[path].encode_batch([t or "" for t in texts], add_special_tokens=False)]


def odd_texts(n=400):
    rnd = random.Random(11)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder(spark, corpus, library, path):
    texts = odd_texts() + [r[0] for r in documents(spark, corpus).select("text").collect()]
    encoder = tokens.Encoder(path)
    encoder._words._most = encoder._units._most = 500  # the tables are cleared again and again
    got = [np.frombuffer(x, "<u2").tolist() for _, part in tokens.in_pieces(texts, 3000) for x in encoder.encode(part)]
    assert got == ids_of(library, path, texts)


def test_plain_texts_need_no_tables(library, monkeypatch):
    """Texts of plain characters and lone blanks are encoded whole, others by units; ids are the library's."""
    rnd = random.Random(5)
    words = ["it's", "I'LL", "'re", "don't'", "x1y2", "123", "...", "Éa,", "œuvre", "a-b", "!?", "the", "$5", "Ŋ", "q" * 3000, "<a>", "'"]
    plain = ["", "a", "'s"]
    for _ in range(400):
        picked = rnd.choices(words, k=rnd.randint(1, 40))
        plain.append("".join(w + rnd.choice([" ", "\n", ""]) for w in picked[:-1]) + picked[-1])
    plain = [x for x in plain if "<|" not in x]
    odd = [x + y for x, y in zip(plain, ["  z", "\n\nb", " ", "<|endoftext|>", " \n c", "\t", " 漢"] * 10)]
    want = ids_of(library, BYTE, plain + odd)
    encoder = tokens.Encoder(BYTE)
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(plain + odd)] == want
    monkeypatch.setattr(tokens.UnitCache, "over", lambda self, units: {"\n": b""} if not any(set(x) - {"\n"} for x in units) else 1 / 0)
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(plain)] == want[:len(plain)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join) | st.text(max_size=30))
def test_any_text(text):
    for path in (BYTE, WORD):
        library = Tokenizer.from_file(path) if path not in _LIBRARIES else _LIBRARIES[path]
        _LIBRARIES[path] = library
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(tokens.encoder(path).encode([text])[0], "<u2").tolist() == want
        if path == WORD:
            ids = bpe._bpe(WORD).encode([text])[0]
            assert ids.tolist() == want
            assert bpe._bpe(WORD).decode(ids) == library.decode(want, skip_special_tokens=False)


_LIBRARIES: dict = {}


def test_characters_on_which_editions_of_unicode_differ(library):
    texts = [":\U0003d000", "a\U0003d000", "1\u0558x", "\U000105c0ab", "x\ua7cb", "a\u0378 b:\u0378<|endoftext|>"]
    assert [x.tolist() for x in bpe.WordBpe(WORD).encode(texts)] == ids_of(library, WORD, texts)


def test_compatible_pairs_are_those_that_merging_leaves():
    b = bpe._bpe(WORD)
    rnd = random.Random(3)
    whole = [i for t, i in b.proposed.items()]
    opening = [i for i in whole if not b.names[i].endswith(bpe.END_OF_WORD)]
    pairs = [(rnd.choice(opening), rnd.choice(whole)) for _ in range(3000)]
    got = b.compatible(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    want = [b.exact(b._symbols(b.names[x]) + b._symbols(b.names[y])) == [x, y] for x, y in pairs]
    assert got.tolist() == want


def test_long_words_merge_exactly(library):
    texts = ["ab" * 3000, "aaaa" * 500 + "b", "q" * 33]
    assert [x.tolist() for x in bpe.WordBpe(WORD).encode(texts)] == ids_of(library, WORD, texts)


def test_round_trip(docs, library):
    texts = [r[1] for r in cases()]
    want = ids_of(library, WORD, texts)
    got = bpe.bpe_round_trip(docs, WORD).collect()
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in got) == Counter(
        (c[0], tuple(i), library[WORD].decode(i, skip_special_tokens=False)) for c, i in zip(cases(), want))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, docs, library):
    folder = work_folder(spark, "files")
    token_files.write_token_files(docs, folder, WORD, block_ids=500)
    got = sorted(token_files.read_token_files(spark, folder, with_ids=True).collect(), key=lambda r: r["start"])
    want = Counter((c[0], crc(i + [1])) for c, i in zip(cases(), ids_of(library, WORD, [c[1] for c in cases()])))
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in got) == want
    at = 0
    for r in got:
        ids = np.frombuffer(r["ids"], "<u2").tolist()
        assert (r["start"], r["n_tokens"], crc(ids)) == (at, len(ids), r["ids_crc32"])
        at += len(ids)
    named = [r["doc_id"] for r in got]
    assert named == sorted(named, key=lambda x: (x is not None, x or 0))


def test_words_by_ranks(library):
    """Words of accented letters, capitals and a point after them, tokens of the vocabulary among them."""
    rnd = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzaeinrstàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþßÀÉÖÞZ"
    words = [t.removesuffix("</w>") for t in list(library[WORD].get_vocab())[::5]]
    words += ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 12))) for _ in range(5000)]
    words = [w + rnd.choice(["", ".", ",", "..", ".,", "ß"]) for w in words if " " not in w]
    got = tokens.Encoder(WORD).encode([" ".join(words), *words])
    want = ids_of(library, WORD, [" ".join(words), *words])
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == want


def test_look_up(spark, library):
    """Single documents by select: negative, repeated, unknown and null ids, small blocks."""
    rows = [(i % 150 - 40 if i % 7 else None, f"text {i} " + "more words " * (i % 23)) for i in range(600)]
    rows += [(77, f"one id {i} " * (i % 5)) for i in range(300)] + [(-2**63, "low"), (2**63 - 1, "high")]
    folder = work_folder(spark, "files")
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), folder, WORD,
                                  block_ids=200)
    every = token_files.read_token_files(spark, folder, with_ids=True)
    assert [r[0] for r in every.orderBy("start").collect()] == sorted(
        (r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    asked = [5, 5, -40, 77, 10_000, None, -2**63, 2**63 - 1]
    got = token_files.look_up(spark, folder, spark.createDataFrame([(x, 1) for x in asked], "doc_id long, ids int"))
    want = every.where(F.col("doc_id").isin([x for x in asked if x is not None])).select(got.columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    assert got.where("doc_id = 77").count() == sum(r[0] == 77 for r in rows) > 300


def test_token_files_of_nothing(spark, empty):
    folder = work_folder(spark, "files")
    token_files.write_token_files(empty, folder, WORD)
    assert token_files.read_token_files(spark, folder).collect() == []
    assert token_files.look_up(spark, folder, spark.range(3).select(F.col("id").alias("doc_id"))).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**62), max_size=700).map(sorted))
def test_elias_fano(values):
    fano = token_files.EliasFano.of(np.array(values, np.uint64))
    assert fano.all().tolist() == values
    assert [fano[i] for i in range(0, len(values), 7)] == values[::7]
    if values:
        assert 8 * (len(fano.low) + len(fano.high)) <= len(values) * (3 + max(0, (values[-1] // len(values)).bit_length())) + 16


def check_pieces(rows, want, tiers):
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append(r)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= tiers[-1]
        assert pieces[0]["tier"] in (0, at)
        padding += 0 if at & (at - 1) == 0 else tiers[-1] - at
    for r in rows:
        by_doc[r["doc_id"], r["doc_tokens"]].append(r)
    got = Counter()
    for (doc, n), pieces in by_doc.items():
        starts = sorted((r["start"], r["length"], r["ids_crc32"]) for r in pieces)
        got[doc, n, tuple(starts)] += 1
    return got, padding


def test_packing(spark, docs, library):
    wanted = {}
    for c, ids in zip(cases(), ids_of(library, BYTE, [c[1] for c in cases()])):
        wanted[c[0], len(ids) + 1] = ids + [1]
    tiers = (16, 32, 64)
    rows = packing.pack(docs, BYTE, tiers=tiers, pool=5).collect()
    got, _ = check_pieces(rows, None, tiers)
    copies = Counter((c[0], len(i) + 1) for c, i in zip(cases(), ids_of(library, BYTE, [c[1] for c in cases()])))
    for (doc, n, pieces), _ in got.items():
        held = np.zeros(n, int)
        for start, length, check in pieces:
            held[start:start + length] += 1
            assert check == crc(wanted[doc, n][start:start + length])
        assert (held == copies[doc, n]).all()
    assert {(d, n) for d, n, _ in got} == set(wanted)


def test_packing_pads_little(spark, corpus):
    rows = packing.pack(documents(spark, corpus), BYTE).collect()
    _, padding = check_pieces(rows, None, packing.TIERS)
    assert padding < 0.02 * sum(r["length"] for r in rows)
    steps = Counter()
    for r in rows:
        steps[r["step_group"]] += r["length"]
    assert max(steps.values()) <= packing.STEP_TOKENS


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=60), st.integers(1, 12))
def test_packer_places_each_id_once(lengths, pool):
    packer = packing.Packer((8, 16, 32, 64), pool)
    for i, n in enumerate(lengths):
        packer.add(i, n)
    packer.finish()
    held = [np.zeros(n, int) for n in lengths]
    short = 0
    for tier, pieces in packer.done:
        size = sum(p.length for p in pieces)
        assert size == tier
        short += tier not in packer.tiers
        for p in pieces:
            held[p.doc][p.start:p.start + p.length] += 1
    assert all((h == 1).all() for h in held) and short <= 1 and not packer.rests


def test_empty_tables(empty):
    assert packing.pack(empty, BYTE).collect() == []
    assert bpe.bpe_round_trip(empty, WORD).collect() == []
    assert token_counts.apply_edits(token_counts.count_trees(empty, BYTE), BYTE).collect() == []


@pytest.mark.parametrize("units", [1, 2, 32])
def test_counts_follow_edits(library, units):
    rnd = random.Random(units)
    bits = ["a", "the", " ", "  ", "\n", " \n", ".", " the", "12", "é", "\xa0", "'s", " ing", "thing ", ""]
    counter = token_counts.Counter(BYTE, units)
    for _ in range(150):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 200)))
        tree = counter.trees([text])[0]
        for _ in range(3):
            at = sorted(rnd.randint(0, len(text)) for _ in range(2 * rnd.randint(0, 4)))
            edits = [(a, b, rnd.choice([*bits, "foo bar baz", "x " * 10])) for a, b in zip(at[::2], at[1::2])]
            want = token_counts.edited(text, edits)
            text, _ = counter.apply(text, tree, edits)
            assert text == want
            assert tree.total == len(library[BYTE].encode(want, add_special_tokens=False).ids)
            assert int(tree.lengths.sum()) == len(want)


def test_only_touched_segments_are_counted_again():
    counter = token_counts.Counter(BYTE)
    text = " ".join(f"word{i}" for i in range(20_000))
    tree = counter.trees([text])[0]
    _, again = counter.apply(text, tree, [(50_000, 50_004, "changed here")])
    assert again <= 3 < len(tree.lengths) // 100


def test_count_queries(docs, library):
    trees = token_counts.count_trees(docs, BYTE)
    out = token_counts.apply_edits(trees, BYTE).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(c[0] for c in cases())
    for r in out:
        assert r["n_tokens"] == len(library[BYTE].encode(r["text"], add_special_tokens=False).ids)
    assert any(r["n_edits"] for r in out)
    given_edits = trees.selectExpr("*", "CASE WHEN length(text) > 4 THEN array(named_struct('start', 0, 'end', 2, 'replacement', 'Z z')) END AS edits")
    for r in token_counts.apply_edits(given_edits, BYTE, "edits").collect():
        assert r["n_tokens"] == len(library[BYTE].encode(r["text"], add_special_tokens=False).ids)


def test_cleaning_edits():
    text = "mail joe.x@mail.example.com or +1 (017) 555-7713\nline\nline\n10.20.30.40 and 4845168114407329"
    assert token_counts.edited(text, token_counts.cleaning_edits(text)) == (
        "mail <email> or <phone>\nline\n<address> and <number>")


def test_one_step_counts_as_two_do(docs):
    two = token_counts.apply_edits(token_counts.count_trees(docs, BYTE), BYTE)
    one = token_counts.count_edited(docs, BYTE)
    assert one.columns == two.columns
    def key(r):
        return str(r)

    assert sorted(map(key, one.collect())) == sorted(map(key, two.collect()))
