"""Exact, line, substring and near-duplicate dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from supplierlens.llm import exact_dedup, line_dedup, minhash_dedup, substring_dedup, text_hash
from supplierlens.llm.common import documents
from supplierlens.llm.components import components
from tests.llm.conftest import cases

BLANKS = " \t\n\x0b\x0c\r"


def table(spark, corpus):
    return [(r["doc_id"], r["text"]) for r in documents(spark, corpus).select("doc_id", "text").collect()]


def exact_by_hand(rows):
    groups = defaultdict(list)
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    for (i, t), n in zip(rows, norm):
        groups[n].append((-len(t or ""), i is None, i or 0, i))
    return Counter((i, min(groups[n])[3], len(groups[n]), min(groups[n])[3] == i, hashlib.sha256(n.encode()).hexdigest())
                   for (i, _), n in zip(rows, norm))


@pytest.mark.parametrize("source", ["docs", "corpus"])
def test_exact(spark, docs, corpus, source):
    rows = [r[:2] for r in cases()] if source == "docs" else table(spark, corpus)
    df = docs if source == "docs" else documents(spark, corpus)
    out = exact_dedup.exact_dedup(df, hash_all=True).collect()
    assert Counter(map(tuple, out)) == exact_by_hand(rows)
    lazy = exact_dedup.exact_dedup(df).collect()
    assert Counter(r[:4] for r in map(tuple, lazy)) == Counter(r[:4] for r in map(tuple, out))
    assert any(r["text_sha256"] is None for r in lazy) and all(r["text_sha256"] for r in lazy if r["group_size"] > 1)


def test_hot_copies(spark):
    rows = [(i, "one text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    out = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert sum(r["kept"] for r in out) == 2001 and max(r["group_size"] for r in out) == 1000


def lines_by_hand(rows):
    def key(line):
        return re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(BLANKS))

    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(i)
    stays = {k: max(x for x in ids if x is not None) for k, ids in held.items() if len(k) >= 20 and len(ids) >= 3}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if key(x) not in stays or stays[key(x)] == i]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return Counter(out)


@pytest.mark.parametrize("source", ["docs", "corpus"])
def test_lines(spark, docs, corpus, source):
    rows = [r[:2] for r in cases()] if source == "docs" else table(spark, corpus)
    df = docs if source == "docs" else documents(spark, corpus)
    want = lines_by_hand(rows)
    assert Counter(map(tuple, line_dedup.line_dedup(df).collect())) == want
    assert any(x[3] for x in want)


def shingle_sets(rows, k):
    out = []
    for _, t in rows:
        w = re.sub(r"[A-Z]", lambda m: m[0].lower(), t or "").split(" ")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", " ".join(w)) if x]
        out.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else
                   frozenset([tuple(w)] if w else []))
    return out


def near_by_hand(rows, k):
    sets = shingle_sets(rows, k)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    usable = [i for i, r in enumerate(rows) if r[0] is not None]
    for a in usable:
        for b in usable:
            if a < b and (rows[a][0] == rows[b][0] or sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    low = defaultdict(list)
    for i in usable:
        low[find(i)].append(rows[i][0])
    own = {i: min(low[find(i)]) for i in usable}
    return Counter((r[0], len(sets[i]), own.get(i), own.get(i) == r[0]) for i, r in enumerate(rows))


@pytest.mark.parametrize(("source", "k"), [("docs", 4), ("docs", 5), ("corpus", 5)])
def test_near(spark, docs, corpus, source, k):
    rows = [r[:2] for r in cases()] if source == "docs" else table(spark, corpus)
    df = docs if source == "docs" else documents(spark, corpus)
    got = Counter(map(tuple, minhash_dedup.minhash_dedup(df, minhash_dedup.Settings(words=k)).collect()))
    want = Counter((i, n, c, True if i is None else kept) for (i, n, c, kept), m in near_by_hand(rows, k).items() for _ in range(m))
    assert got == want


def test_near_groups_with_outsiders(spark):
    """Copies of one text with one to nine words changed: only some pairs are links."""
    words = [f"w{i}" for i in range(150)]
    rows = []
    for d in range(300):
        own = list(words)
        for e in range(d % 10):
            own[(d * 37 + e * 53) % 150] = f"new{d}x{e}"
        rows.append((d, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter(map(tuple, minhash_dedup.minhash_dedup(df, minhash_dedup.Settings(words=4, block=16)).collect()))
    assert got == near_by_hand(rows, 4)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7), (300, 301), (301, 300)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {out[i] for i in range(41)} == {0} and {out[200 + i] for i in range(30)} == {100} and out[301] == 300


def spans_by_hand(rows, min_sentences, min_words):
    """The rules of the operator on plain strings, with the same picked words."""
    def units(text):
        words = list(re.finditer(r"[^\x20\x09-\x0D]+", text))
        hashes = [text_hash.words(p).hashes[0] for w in words for p in text_hash.texts(_arrow([w[0]]))]
        sentence, sentences = [], []
        for n, w in enumerate(words):
            sentence.append(n)
            ends = re.search(r"[.!?][\"')\]}]?$", w[0]) is not None
            feed = n + 1 < len(words) and "\n" in text[w.end():words[n + 1].start()]
            if ends or feed or n + 1 == len(words):
                sentences.append(sentence)
                sentence = []
        out = []
        for s in sentences:
            now = []
            for n in s:
                now.append(n)
                if n == s[-1] or len(s) > substring_dedup.LONG_SENTENCE and (int(hashes[n]) >> 40) % substring_dedup.CUT_ONE_IN == 0:
                    out.append(now)
                    now = []
        return words, out

    places, texts = defaultdict(list), {}
    for i, t in rows:
        words, found = units(t or "")
        texts[i, t] = (t or "", words, found)
        if i is None:
            continue
        for a in range(len(found)):
            b = a
            while b < len(found) and (b - a < min_sentences or sum(map(len, found[a:b])) < min_words):
                b += 1
            if b - a >= min_sentences and sum(map(len, found[a:b])) >= min_words:
                run = tuple(re.sub("[A-Z]", lambda m: m[0].lower(), words[n][0]) for u in found[a:b] for n in u)
                places[run].append((i, a, b))
    covered = defaultdict(set)
    for found in places.values():
        first = min(found)[:2]
        for i, a, b in found:
            if (i, a) != first:
                covered[i].update(range(a, b))
    out = []
    for i, t in rows:
        text, words, found = texts[i, t]
        gone = covered[i] if i is not None else set()
        left = text
        if gone:
            starts = [words[u[0]].start() for u in found] + [len(text)]
            left = text[:starts[0]] + "".join(text[starts[j]:starts[j + 1]] for j in range(len(found)) if j not in gone)
        out.append((i, left, len(found), len(gone), len(text) - len(left)))
    return Counter(out)


def _arrow(values):
    import pyarrow as pa

    return pa.array(values)


@pytest.mark.parametrize("source", ["docs", "corpus"])
def test_substrings(spark, docs, corpus, source):
    rows = [r[:2] for r in cases()] if source == "docs" else table(spark, corpus)[:120]
    df = docs if source == "docs" else spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r)[:5] for r in substring_dedup.substring_dedup(df).collect())
    want = spans_by_hand(rows, substring_dedup.MIN_SENTENCES, substring_dedup.MIN_WORDS)
    assert got == want
    assert any(x[3] for x in want)


def test_planted_passage_goes_and_clean_text_stays(spark):
    def prose(seed, n):
        return " ".join(f"v{seed}q{i}" + ("." if i % 9 == 8 else "") for i in range(n))

    passage = prose("pass", 60)
    rows = [(i, prose(i, 100) + (" " + passage + " " if i in (3, 8) else " ") + prose(f"{i}b", 80)) for i in range(12)]
    out = {r["doc_id"]: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[i]["n_removed"] == 0 for i in out if i != 8)
    assert sum(w in out[8]["text"] for w in passage.split()) <= 18
    assert "v8q0 " in out[8]["text"] and out[8]["text"].endswith("v8bq79")


@pytest.mark.parametrize("stop", ["", "."])
def test_a_passage_goes_however_its_lines_are_wrapped(spark, stop):
    def prose(seed, n):
        return [f"v{seed}q{i}" + (stop if i % 30 == 29 else "") for i in range(n)]

    def wrapped(words, width):
        return "\n".join(" ".join(words[i:i + width]) for i in range(0, len(words), width))

    passage = prose("pass", 200)
    widths = {1: 200, 2: 10, 3: 12, 4: 7}
    rows = [(i, "\n".join([" ".join(prose(i, 50)), wrapped(passage, n), " ".join(prose(f"{i}b", 50))])) for i, n in widths.items()]
    out = {r["doc_id"]: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1]["text"] == rows[0][1] and out[1]["n_removed"] == 0
    for i in (2, 3, 4):
        left = out[i]["text"].split()
        assert sum(w in left for w in passage) <= 30 and out[i]["n_removed"] > 0
        assert [w for w in left if w not in passage] == prose(i, 50) + prose(f"{i}b", 50)


def test_a_block_of_lines_goes_whole(spark):
    block = "\n".join(" ".join(f"l{i}w{j}" for j in range(9)) for i in range(3))
    rows = [(i, f"head{i}\n{block}\ntail{i}") for i in (1, 2)]
    out = {r["doc_id"]: r["text"] for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: rows[0][1], 2: "head2\ntail2"}


@pytest.mark.parametrize("operator", [exact_dedup.exact_dedup, line_dedup.line_dedup, substring_dedup.substring_dedup,
                                      minhash_dedup.minhash_dedup])
def test_empty_tables(empty, operator):
    assert operator(empty).collect() == []


def test_long_texts_hash_like_short_ones():
    """A text longer than a piece has the words of its parts."""
    words = [f"word{i}" for i in range(300_000)]
    long = next(iter(text_hash.texts(_arrow([" ".join(words)]))))
    assert len(long.data) > text_hash.PIECE_BYTES
    some = next(iter(text_hash.texts(_arrow([" ".join(words[:1000])]))))
    assert (text_hash.words(long).hashes[:1000] == text_hash.words(some).hashes).all()
    assert len(text_hash.words(long).hashes) == 300_000
    huge = next(iter(text_hash.texts(_arrow(["x" * 3_000_000 + " y"]))))
    assert len(text_hash.words(huge).hashes) == 2
