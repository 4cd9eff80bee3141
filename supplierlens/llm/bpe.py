"""Byte-pair encoding by speculation: greedy longest match, checked pair by pair, mended where wrong."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplierlens.llm import tokens

END_OF_WORD = "</w>"
# Fixed value: the word pattern of the vocabulary file.
_SETTLED = re.compile("[\0-\u024f]+").fullmatch
_LETTER, _DIGIT = regex.compile(r"\p{L}").match, regex.compile(r"\p{N}").match


def is_settled(unit: str) -> bool:
    """Whether editions of Unicode agree on what is a letter, a digit or neither in a unit. They
    do not on characters that are unassigned in one of them; the library cuts such units."""
    if _SETTLED(unit):
        return True
    for c in unit:
        kind = unicodedata.category(c)
        if kind == "Cn" or (kind[0] == "L") != bool(_LETTER(c)) or (kind[0] == "N") != bool(_DIGIT(c)):
            return False
    return True


_words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall


def split_words(text: str) -> list[str]:
    """Words of the text, composed and in lower case, each character by itself."""
    return _words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


class WordBpe:
    """Encodes words with a vocabulary whose words end in END_OF_WORD, and decodes ids.

    Inside, tokens are numbered in the order in which merges apply: single symbols first,
    then the result of each merge. ``left`` and ``right`` are the two halves of a merged
    token, and the token itself for a symbol.
    """

    def __init__(self, path: str) -> None:
        self._path = path
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocabulary, merges = file["model"]["vocab"], file["model"]["merges"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        special = {x["content"]: x["id"] for x in file["added_tokens"]}
        made = {a + b for a, b in merges}
        symbols = [t for t in vocabulary if t not in made and t not in special]
        self.names = symbols + [a + b for a, b in merges]
        self.number = {t: i for i, t in enumerate(self.names)}
        self.left, self.right = np.arange(len(self.names)), np.arange(len(self.names))
        self.merged: dict[tuple[int, int], int] = {}
        for i, (a, b) in enumerate(merges, len(symbols)):
            self.left[i], self.right[i] = self.number[a], self.number[b]
            self.merged[self.number[a], self.number[b]] = i
        pairs = np.array([(a << 32 | b, t) for (a, b), t in self.merged.items()], np.int64).reshape(-1, 2)
        pairs = pairs[np.argsort(pairs[:, 0])]
        self._pair, self._pair_token = pairs[:, 0], pairs[:, 1]
        self.ids = np.array([vocabulary[t] for t in self.names], np.int32)
        self.special = special
        self.text_of: dict[int, str] = {vocabulary[t]: t for t in self.names} | {i: t for t, i in special.items()}
        # A token may be proposed only if exact merging of its own symbols gives it back.
        self.proposed = {t: i for i, t in enumerate(self.names) if self.exact(self._symbols(t)) == [i]}
        self._longest: dict[str, int] = {}  # by the first three letters; other tokens have two at most
        for t in self.proposed:
            letters = t.removesuffix(END_OF_WORD)
            self._longest[letters[:3]] = max(self._longest.get(letters[:3], 2), len(letters))
        self._checked = np.zeros(0, np.int64), np.zeros(0, bool)
        self._words = tokens.UnitCache(self.encode_words)
        self._units = tokens.UnitCache(self._encode_units)

    @staticmethod
    def _parts(letters: str) -> list[str]:
        return [*letters[:-1], letters[-1] + END_OF_WORD]

    def _symbols(self, token: str) -> list[int]:
        if token.endswith(END_OF_WORD) and len(token) > len(END_OF_WORD):
            return [self.number[x] for x in self._parts(token.removesuffix(END_OF_WORD))]
        return [self.number[x] for x in token]

    def exact(self, symbols: list[int]) -> list[int]:
        """Merges the neighbours with the earliest merge, leftmost first, until none is left."""
        n = len(symbols)
        if n <= 32:
            token, get, none = list(symbols), self.merged.get, len(self.names)
            while len(token) > 1:
                found = [get(pair, none) for pair in zip(token, token[1:], strict=False)]
                first = min(found)
                if first == none:
                    break
                at = found.index(first)
                token[at:at + 2] = [first]
            return token
        token, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i) for i in range(n - 1) if (m := self.merged.get((token[i], token[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            m, i = heapq.heappop(heap)
            j = after[i] if token[i] >= 0 else n
            if j >= n or self.merged.get((token[i], token[j])) != m:
                continue
            token[i], token[j] = m, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (x := self.merged.get((m, token[after[j]]))) is not None:
                    heapq.heappush(heap, (x, i))
            if before[i] >= 0 and (x := self.merged.get((token[before[i]], m))) is not None:
                heapq.heappush(heap, (x, before[i]))
        return [t for t in token if t >= 0]

    def propose(self, letters: str) -> list[int]:
        """Greedy longest match from the left."""
        out, at, n = [], 0, len(letters)
        get, longest = self.proposed.get, self._longest.get
        while at < n:
            size = min(longest(letters[at:at + 3], 2), n - at)
            while size:
                end = at + size
                t = get(letters[at:] + END_OF_WORD if end == n else letters[at:end])
                if t is not None:
                    break
                size -= 1
            if not size:
                return []
            out.append(t)
            at += size
        return out

    def _look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of the token that two tokens merge to, a number above all if they don't."""
        code = a.astype(np.int64) << 32 | b
        k = np.minimum(np.searchsorted(self._pair, code), len(self._pair) - 1)
        return np.where(self._pair[k] == code, self._pair_token[k], len(self.names))

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the symbols of both tokens gives just these two, for arrays of pairs.

        Merging is undone step by step on both sides of the border, latest merge first. If at
        some step the two tokens at the border merge to one that comes before what was undone
        last, exact merging would have crossed the border there.
        """
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), len(self.names), np.int64)
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y, most = a[live], b[live], limit[live]
            crossed = self._look_up(x, y) < most
            good[live[crossed]] = False
            whole_x, whole_y = self.left[x] == x, self.left[y] == y
            # Undo the later merge; at equal numbers the left one counts as earlier.
            undo_x = ~whole_x & ((x > y) | whole_y)
            undo_y = ~whole_y & ~undo_x
            limit[live] = np.where(undo_x, x, np.where(undo_y, y + 1, most))
            a[live] = np.where(undo_x, self.right[x], x)
            b[live] = np.where(undo_y, self.left[y], y)
            live = live[~crossed & (undo_x | undo_y)]
        return good

    def _check(self, codes: np.ndarray) -> np.ndarray:
        """``compatible`` for coded pairs, with a table of the pairs seen before."""
        known, verdict = self._checked
        new = np.unique(codes)
        if len(known):
            new = new[known[np.minimum(np.searchsorted(known, new), len(known) - 1)] != new]
        if len(new):
            good = self.compatible(new >> 32, new & 0xFFFFFFFF)
            known, verdict = np.concatenate([known, new]), np.concatenate([verdict, good])
            order = np.argsort(known)
            self._checked = known, verdict = known[order], verdict[order]
        return verdict[np.searchsorted(known, codes)]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 16-bit numbers."""
        letters = [w.encode().decode("latin-1").translate(tokens.BYTE_LETTERS) for w in words]
        found = [self.propose(x) for x in letters]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((t for x in found for t in x), np.int64, int(sizes.sum()))
        word = np.repeat(np.arange(len(found)), sizes)
        wrong = sizes == 0
        if len(flat) > 1:
            together = word[1:] == word[:-1]
            good = self._check((flat[:-1] << 32 | flat[1:])[together])
            wrong[word[1:][together][~good]] = True
        for i in np.flatnonzero(wrong):
            found[i] = self.exact([self.number[x] for x in self._parts(letters[i])])
        ids = self.ids.astype("<u2")
        return [ids[x].tobytes() for x in found]

    def _encode_units(self, units: list[str]) -> list[bytes]:
        asked = {i for i, x in enumerate(units) if not is_settled(x)}
        plain = [split_words(x) if "<|" not in x and i not in asked else [] for i, x in enumerate(units)]
        known = self._words.over(plain).__getitem__
        out = [b"".join(map(known, x)) for x in plain]
        for i in asked:
            out[i] = self._library().encode([units[i]])[0]
        for i, unit in enumerate(units):
            if "<|" in unit and i not in asked:  # it may hold names of special tokens, which are tokens of their own
                parts = [x if x in self.special else split_words(x) for x in self._cut(unit)]
                known = self._words.over([x for x in parts if isinstance(x, list)])
                out[i] = b"".join(self.special[x].to_bytes(2, "little") if isinstance(x, str)
                                  else b"".join(known[w] for w in x) for x in parts)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts."""
        split = [tokens.split_dropping(x) for x in texts]
        known = self._units.over(split).__getitem__
        return [np.frombuffer(b"".join(map(known, x)), "<u2") for x in split]

    def _library(self) -> tokens.Encoder:
        return tokens.encoder(self._path)

    def _cut(self, text: str) -> list[str]:
        """The text cut at the names of special tokens."""
        return [x for x in re.split("(" + "|".join(map(re.escape, self.special)) + ")", text) if x]

    def decode(self, ids: np.ndarray) -> str:
        """Names of the ids, joined by a blank: the vocabulary has no decoder of its own."""
        return " ".join(map(self.text_of.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def _bpe(path: str) -> WordBpe:
    return WordBpe(path)


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ids (array of int), decoded (text of these ids).

    Every whole text is encoded, null as empty; empty and blank texts have no ids. Rows
    repeated or without an id get rows of their own. Other columns are not looked at; an
    empty table gives an empty one. Each task reads, encodes and decodes its own rows, and a
    worker keeps a bounded number of distinct words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(path)
        for batch in batches:
            for first, texts in tokens.in_pieces(batch.column(1).to_pylist()):
                ids = bpe.encode(texts)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                     pa.array([bpe.decode(x) for x in ids], pa.string())], ["doc_id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>, decoded string")
