"""Substring dedup: words inside spans that an earlier place of the corpus holds too."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplierlens.llm import text_hash
from supplierlens.llm.common import written

MIN_SENTENCES = 3
MIN_WORDS = 25
#: A sentence of more words is also cut after words that a hash picks, about one in CUT_ONE_IN.
#: The words decide, not their place, so that a passage set into other text is cut alike.
LONG_SENTENCE = 12
CUT_ONE_IN = 4

_CLOSERS = np.zeros(256, bool)
_CLOSERS[[ord(c) for c in "\"')]}"]] = True
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True


def _firsts(closed: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """Number of the first word of each sentence, and the number of words, given the words that close one."""
    firsts = np.concatenate([[0], np.flatnonzero(closed) + 1])
    sizes = np.diff(firsts)
    inside_long = np.repeat(sizes > LONG_SENTENCE, sizes)
    return np.concatenate([[0], np.flatnonzero(closed | (inside_long & picked)) + 1])


def _sentences(w: text_hash.Words, part: text_hash.Texts, row: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the first word of each sentence of a row, and the number of its words: with line
    feeds as ends of sentences, and with line feeds as any other blank."""
    lo, hi = w.bounds[row], w.bounds[row + 1]
    n = hi - lo
    if n == 0:
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    ends = w.ends[lo:hi]
    last = part.data[ends - 1]
    closed = _ENDS[last] | (_CLOSERS[last] & _ENDS[part.data[np.maximum(ends - 2, w.starts[lo:hi])]])
    closed[-1] = True
    picked = (w.hashes[lo:hi] >> np.uint64(40)) % np.uint64(CUT_ONE_IN) == 0
    unwrapped = _firsts(closed, picked)
    text_start, text_end = part.offsets[row], part.offsets[row + 1]
    feeds = text_start + np.flatnonzero(part.data[text_start:text_end] == 10)
    fed = np.searchsorted(feeds, ends[:-1]) < np.searchsorted(feeds, w.starts[lo + 1:hi])
    if not (fed & ~closed[:-1]).any():
        return unwrapped, unwrapped
    closed[:-1] |= fed
    return _firsts(closed, picked), unwrapped


def _spans(hashes: np.ndarray, cuts: tuple[np.ndarray, np.ndarray], min_sentences: int, min_words: int,
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each run from a sentence on that first has both minima, by either way to cut: first word, end, hash."""
    def runs(firsts: np.ndarray) -> np.ndarray:
        k = len(firsts) - 1
        starts = np.arange(k)
        ends = np.maximum(starts + min_sentences, np.searchsorted(firsts, firsts[:-1] + min_words, "left"))
        ok = ends <= k
        return firsts[starts[ok]] * (len(hashes) + 1) + firsts[ends[ok]]

    lines, unwrapped = cuts
    found = runs(lines) if lines is unwrapped else np.union1d(runs(lines), runs(unwrapped))
    starts, ends = np.divmod(found, len(hashes) + 1)
    return starts, ends, text_hash.range_hashes(hashes, starts, ends)


def sentence_spans(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """(span, doc_id, first, last): hash of a run, its document and word numbers [first, last)."""
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_hash.texts(batch.column(1)):
                w = text_hash.words(part)
                rows, found = [], []
                for i in range(len(part)):
                    own = w.hashes[w.bounds[i]:w.bounds[i + 1]]
                    got = _spans(own, _sentences(w, part, i), min_sentences, min_words)
                    found.append(got)
                    rows.append(np.full(len(got[0]), part.first + i))
                first, last, span = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(span.view(np.int64)), batch.column(0).take(pa.array(np.concatenate(rows))),
                     pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                    ["span", "doc_id", "first", "last"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        spans, f"span long, doc_id {id_type}, first int, last int")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS,
                    carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: id, text (what is left), n_sentences, n_removed,
    n_chars_removed, and ``carried``, a struct of the columns named by ``carry``.

    A span is a run of consecutive sentences, the shortest from its first sentence on with
    ``min_sentences`` sentences and ``min_words`` words, blanks and the case of A-Z aside. Each
    text is cut twice: at punctuation and line feeds, so that blocks of lines are found whole,
    and at punctuation alone, so that a passage is found however its lines are wrapped. Of
    all places of a span the first, by id and then place, stays; words that another of its
    places covers are removed, with the blanks after them. n_sentences counts sentences with
    line feeds as ends, n_removed those of them that lost words. Null texts are empty. Rows
    repeated under one id are one document and are treated alike; a row without an id holds
    no spans and stays as it is. Other columns are not looked at; an empty table gives an
    empty one.

    Spans are 64-bit hashes. Their first pass keeps only hashes of more than one place, with
    the first place, combined before the shuffle; the places of these are joined to it, where
    adaptive execution may split a span that many documents share. A document's covered
    runs of words come back as one list, of at most two for each of the document's words.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.struct(F.lit(0).alias("_"), *carry).alias("carried"))
    # Made twice: hashing the texts again takes less than writing a row for every sentence.
    spans = sentence_spans(base.where("doc_id IS NOT NULL"), min_sentences, min_words)
    place = F.struct("doc_id", "first")
    repeated = written(spans.groupBy("span").agg(F.min(place).alias("kept"), F.max(place).alias("other"))
                       .where("kept <> other").select("span", "kept"), "substring-repeated")
    covered = (spans.join(repeated, "span").where(~place.eqNullSafe(F.col("kept")))
               .groupBy(F.col("doc_id").alias("in_doc"))
               .agg(F.collect_set(F.struct("first", "last")).alias("runs")))

    def remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, gone, lost = [], [], [], []
            runs = batch.column(2)
            for part in text_hash.texts(batch.column(1)):
                w = text_hash.words(part)
                for i in range(len(part)):
                    firsts, _ = _sentences(w, part, i)
                    lo, end = part.offsets[i], part.offsets[i + 1]
                    whole = part.data[lo:end].tobytes()
                    n = firsts[-1]
                    own = runs[part.first + i]
                    cover = np.zeros(n + 1, np.int64)
                    if own.is_valid:
                        np.add.at(cover, np.asarray(own.values.field(0)), 1)
                        np.add.at(cover, np.asarray(own.values.field(1)), -1)
                    out = np.cumsum(cover)[:n] > 0
                    if out.any():
                        at = np.append(w.starts[w.bounds[i]:w.bounds[i + 1]] - lo, len(whole))
                        turns = np.flatnonzero(np.diff(out, prepend=True, append=True))
                        kept = [whole[:at[0]]] + [whole[at[a]:at[b]] for a, b in turns.reshape(-1, 2)]
                        left = b"".join(kept).decode()
                    else:
                        left = whole.decode()
                    texts.append(left)
                    counts.append(len(firsts) - 1)
                    gone.append(int(np.logical_or.reduceat(out, firsts[:-1]).sum()) if n else 0)
                    lost.append(len(whole.decode()) - len(left) if out.any() else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                 pa.array(gone, pa.int64()), pa.array(lost, pa.int64()), batch.column(3)],
                ["doc_id", "text", "n_sentences", "n_removed", "n_chars_removed", "carried"])

    id_type = base.schema["doc_id"].dataType.simpleString()
    return (base.join(covered, base["doc_id"] == covered["in_doc"], "left")
            .select("doc_id", "text", "runs", "carried")
            .mapInArrow(remaining, f"doc_id {id_type}, text string, n_sentences long, n_removed long, "
                                   f"n_chars_removed long, carried {base.schema['carried'].dataType.simpleString()}"))
