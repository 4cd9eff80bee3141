"""Token counts that follow edits: a tree of segment counts for each document."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplierlens.llm import text_hash, tokens

#: Pre-token units of a segment, the leaf of a tree.
SEGMENT_UNITS = 32

#: (first character, end, replacement), in characters of the text before all edits.
Edit = tuple[int, int, str]

_MASKS = (
    (re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"), "<email>"),
    (re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w.]*\d)"), "<address>"),
    (re.compile(r"\+\d{1,3}[ (]+\d{2,4}[) -]+\d{3}-\d{4}"), "<phone>"),
    (re.compile(r"(?<!\w)\d{13,19}(?!\w)"), "<number>"),
    (re.compile(r"(?<!\w)[0-9a-f]{32,}(?!\w)"), "<secret>"),
)


def cleaning_edits(text: str) -> list[Edit]:
    """Edits that mask personal data and secrets and delete lines equal to an earlier line."""
    found: list[Edit] = []
    seen: set[str] = set()
    at = 0
    for line in text.split("\n"):
        if line.strip() and line in seen:
            found.append((at - 1, at + len(line), ""))
        seen.add(line)
        at += len(line) + 1
    for pattern, name in _MASKS:
        found += [(m.start(), m.end(), name) for m in pattern.finditer(text)]
    out: list[Edit] = []
    for edit in sorted(found, key=lambda e: (e[0], -e[1])):
        if not out or edit[0] >= out[-1][1]:
            out.append(edit)
    return out


def edited(text: str, edits: list[Edit]) -> str:
    parts, at = [], 0
    for start, end, new in edits:
        parts += [text[at:start], new]
        at = end
    return "".join([*parts, text[at:]])


@dataclass
class CountTree:
    """Lengths in characters of a text's segments, and a heap of their token counts.

    ``sums`` has 2 * size places: leaf i is sums[size + i], place k is the sum of places
    2 * k and 2 * k + 1, and sums[1] is the count of the whole text. Segments but the first
    begin at a blank between two other characters, where a text may be cut without a change
    to any token.
    """

    lengths: np.ndarray
    sums: np.ndarray

    @classmethod
    def of(cls, lengths: np.ndarray, counts: np.ndarray) -> CountTree:
        size = 1 << max(0, len(counts) - 1).bit_length()
        sums = np.zeros(2 * size, np.int64)
        sums[size:size + len(counts)] = counts
        level = size
        while level > 1:
            sums[level // 2:level] = sums[level:2 * level].reshape(-1, 2).sum(axis=1)
            level //= 2
        return cls(lengths, sums)

    @property
    def total(self) -> int:
        return int(self.sums[1])

    def put(self, leaf: int, count: int) -> None:
        k = len(self.sums) // 2 + leaf
        change = count - int(self.sums[k])
        while k:
            self.sums[k] += change
            k //= 2


class Counter:
    """Builds and updates trees with one tokenizer that keeps blanks."""

    def __init__(self, path: str, segment_units: int = SEGMENT_UNITS) -> None:
        self._encoder = tokens.encoder(path)
        self._units = segment_units

    def trees(self, texts: list[str]) -> list[CountTree]:
        out = []
        for units, counts in self._encoder.unit_counts(texts):
            chars = np.fromiter(map(len, units), np.int64, len(units))
            chars[1:] += 1
            firsts = np.arange(0, len(units), self._units)
            out.append(CountTree.of(np.add.reduceat(chars, firsts), np.add.reduceat(counts, firsts)))
        return out

    def count(self, text: str) -> int:
        return len(self._encoder.encode([text])[0]) >> 1

    def apply(self, text: str, tree: CountTree, edits: list[Edit]) -> tuple[str, int]:
        """The text after ``edits`` and the number of segments counted anew; updates the tree.

        An edit touches the segments that hold its characters; the one before and the one
        after are its boundary context, since an edit at a border changes what stands next
        to it. Edits whose regions meet are one region. A region that would not begin or end
        in a cut that is safe after the edits grows until it does. Its count goes to its
        first leaf, its other leaves become empty.
        """
        if not edits:
            return text, 0
        starts = np.concatenate([[0], np.cumsum(tree.lengths)])
        last = len(tree.lengths) - 1
        bounds = starts.tolist()
        regions: list[list] = []
        for edit in edits:
            a = max(0, min(last, bisect_right(bounds, edit[0]) - 1) - 1)
            b = min(last, min(last, bisect_right(bounds, max(edit[0], edit[1] - 1)) - 1) + 1)
            if regions and a <= regions[-1][1] + 1:
                regions[-1][1] = max(b, regions[-1][1])
                regions[-1][2].append(edit)
            else:
                regions.append([a, b, [edit]])
        waiting = [(a, b, edited(text[bounds[a]:bounds[b + 1]], [(s - bounds[a], e - bounds[a], x) for s, e, x in own]))
                   for a, b, own in reversed(regions)]
        done: list[tuple[int, int, str]] = []  # (first segment, last one, text) of safe regions
        while waiting:
            first, end, region = waiting.pop()
            while not self._safe(region, first == 0, end == last):
                begins = self._safe(region, first == 0, True)
                if not begins and done and done[-1][1] == first - 1:
                    first, _, before = done.pop()
                    region = before + region
                elif not begins:
                    first -= 1
                    region = text[bounds[first]:bounds[first + 1]] + region
                elif waiting and waiting[-1][0] == end + 1:
                    _, end, more = waiting.pop()
                    region += more
                else:
                    end += 1
                    region += text[bounds[end]:bounds[end + 1]]
            done.append((first, end, region))
        parts, lengths, at, again = [], tree.lengths.copy(), 0, 0
        for first, end, region in done:
            parts += [text[bounds[at]:bounds[first]], region]
            tree.put(first, self.count(region))
            lengths[first] = len(region)
            for leaf in range(first + 1, end + 1):
                tree.put(leaf, 0)
                lengths[leaf] = 0
            again += end - first + 1
            at = end + 1
        tree.lengths = lengths
        return "".join([*parts, text[bounds[at]:]]), again

    @staticmethod
    def _safe(region: str, at_start: bool, at_end: bool) -> bool:
        """Whether a region may be counted by itself: it begins and ends in safe cuts."""
        begins = at_start or (len(region) > 1 and region[0] == " " and not region[1].isspace())
        return begins and (at_end or (region != "" and not region[-1].isspace()))


def count_trees(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text, lengths and sums of its tree.

    A null text is an empty one with a count of 0. Repeated rows and null ids get rows of
    their own; other columns are not looked at; an empty table gives an empty one. Rows are
    independent, so the table may be written and taken up later.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            for first, texts in tokens.in_pieces(batch.column(1).to_pylist()):
                trees = counter.trees(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(texts, pa.string()),
                     pa.array([t.lengths for t in trees], pa.list_(pa.int64())),
                     pa.array([t.sums for t in trees], pa.list_(pa.int64()))], ["doc_id", "text", "lengths", "sums"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, text string, lengths array<long>, sums array<long>")


def count_edited(docs: DataFrame, path: str, edits: Callable[[str], list[Edit]] = cleaning_edits,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``apply_edits`` of ``count_trees``, with the same rows and columns, in one step: a task has
    one Python worker and one table of words, and trees do not pass through the JVM between.

    Null texts are empty; repeated rows and null ids get rows of their own; other columns are
    not looked at; an empty table gives an empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            for piece in text_hash.texts(batch.column(1)):
                rows = batch.slice(piece.first, len(piece))
                texts = [x or "" for x in rows.column(1).to_pylist()]
                yield _edited(counter, rows.column(0), texts, counter.trees(texts), [edits(x) for x in texts])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, {_EDITED}")


_EDITED = ("text string, lengths array<long>, sums array<long>, n_tokens_before long, n_tokens long, n_edits long, "
           "n_segments long, n_recounted long")


def _edited(counter: Counter, ids: pa.Array, texts: list[str], trees: list[CountTree], edits: list[list[Edit]]) -> pa.RecordBatch:
    """Texts and trees after their edits, as rows of _EDITED."""
    out: list[list] = [[] for _ in range(8)]
    for text, tree, own in zip(texts, trees, edits, strict=True):
        before = tree.total
        text, again = counter.apply(text, tree, own)
        for values, x in zip(out, (text, tree.lengths, tree.sums, before, tree.total, len(own), len(tree.lengths), again), strict=True):
            values.append(x)
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [ids, *(pa.array(v, t) for v, t in zip(out, [pa.string(), longs, longs, *[pa.int64()] * 5], strict=True))],
        ["doc_id", *[c.split(" ")[0] for c in _EDITED.split(", ")]])


def apply_edits(trees: DataFrame, path: str, edits: str | Callable[[str], list[Edit]] = cleaning_edits) -> DataFrame:
    """``trees`` after edits: id, text, lengths, sums, n_tokens_before, n_tokens, n_edits,
    n_segments, n_recounted.

    ``edits`` is a function of the text, or the name of a column of ``trees`` with an array
    of (first character, end, replacement); they must not overlap and come in order; null is
    none. Only regions touched by edits, with boundary context, are encoded again.
    """
    named = isinstance(edits, str)
    if named:
        extra = [F.transform(F.col(edits), lambda e: F.struct(
            e.getField("start").cast("long").alias("start"), e.getField("end").cast("long").alias("end"),
            e.getField("replacement").alias("replacement"))).alias("edits")]
    else:
        extra = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            given = batch.column(4).to_pylist() if named else None
            texts = batch.column(1).to_pylist()
            own = [[(e["start"], e["end"], e["replacement"]) for e in x or []] for x in given] if named else [edits(x) for x in texts]
            found = [CountTree(np.array(batch.column(2)[i].values), np.array(batch.column(3)[i].values)) for i in range(len(texts))]
            yield _edited(counter, batch.column(0), texts, found, own)

    kind = trees.schema["doc_id"].dataType.simpleString()
    return trees.select("doc_id", "text", "lengths", "sums", *extra).mapInArrow(
        run, f"doc_id {kind}, {_EDITED}")
