"""Quality rules as a short-circuit cascade, ordered by rejection per cost on a sample."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplierlens.llm.common import BLANKS, let, without, written

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Rows on which cost and selectivity are estimated. They decide the order of the rules and
#: nothing else: every order rejects the same rows.
SAMPLE_ROWS = 400
_BLANK = r"[\x20\x09-\x0D]+"
_NO_BLANK = r"[^\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """Runs of non-blank characters, in order."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _BLANK))


def word_chars(text: Column) -> Column:
    return F.char_length(without(text, BLANKS)).cast("long")


def symbol_count(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(without(text, SYMBOLS))).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(_NO_BLANK))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(word_array: Column, window: int = WINDOW) -> Column:
    """Words inside ``window``-word runs that occur twice or more in the text, all occurrences.

    Hashes of runs are built by doubling (1, 2, 4, 8 words). Most texts have no repeated run,
    which a hash set tells; only the others sort (hash, position) pairs, keep positions with
    an equal neighbour, and add up the words that their runs cover.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")

    def doubled(hashes: Column, step: int) -> Column:
        return let(hashes, lambda h: F.zip_with(
            F.slice(h, 1, F.greatest(F.size(h) - step, F.lit(0))),
            F.slice(h, step + 1, F.greatest(F.size(h) - step, F.lit(0))),
            lambda a, b: F.xxhash64(a, b)))

    runs, step = F.transform(word_array, lambda w: F.xxhash64(w)), 1
    while step < window:
        runs, step = doubled(runs, step), step * 2

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        at = let(pairs, lambda p: F.filter(
            F.transform(p, lambda x, k: F.when(
                (x["h"] == F.get(p, k - 1)["h"]) | (x["h"] == F.get(p, k + 1)["h"]), x["i"])),
            lambda x: x.isNotNull()))
        return F.aggregate(
            F.sort_array(at), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda acc, p: F.struct(
                (acc["n"] + F.least(F.lit(window), p + window - acc["end"])).alias("n"),
                (p + window).alias("end")),
            lambda acc: acc["n"])

    return let(runs, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h))
               .otherwise(F.lit(0))).cast("long")


#: Measures of a text and its array of words.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, w: F.size(w).cast("long"),
    "word_chars": lambda text, w: word_chars(text),
    "n_symbols": lambda text, w: symbol_count(text),
    "n_dup_lines": lambda text, w: repeated_lines(text),
    "n_repeat_words": lambda text, w: repeated_words(w),
}


@dataclass(frozen=True)
class Rule:
    """Rejects a row when ``rejects`` is true; it gets measures by name, computed where asked."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]


BASE_RULES = (
    Rule("too_few_words", lambda m: m("n_words") < 20),
    Rule("repeats_itself", lambda m: 100 * m("n_repeat_words") > 30 * m("n_words")),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 15 * m("n_words"))),
    Rule("repeated_lines", lambda m: 100 * m("n_dup_lines") > 10 * m("n_words")),
)


def order_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text",
                sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[Rule]:
    """The rules, those first that reject most rows of a sample for the time they take.

    An empty table leaves the order as given.
    """
    total = docs.count()
    if not total:
        return list(rules)
    sample = written(docs.select(F.coalesce(text_col, F.lit("")).alias("text"))
                     .sample(min(1.0, sample_rows / total), seed), "quality-sample")
    worded = sample.withColumn("words", words(F.col("text")))
    m = _inline
    ranked = []
    for rule in rules:
        took = []
        for _ in range(2):  # the first run compiles
            began = time.monotonic()
            rejected = worded.agg(F.count_if(rule.rejects(m)), F.count(F.lit(1))).first()
            took.append(time.monotonic() - began)
        ranked.append((-(rejected[0] / max(rejected[1], 1)) / max(min(took), 1e-3), len(ranked), rule))
    return [rule for *_, rule in sorted(ranked, key=lambda x: x[:2])]


def _inline(name: str) -> Column:
    return MEASURES[name](F.col("text"), F.col("words"))


def _verdict(ordered: Sequence[Rule], m: Callable[[str], Column]) -> Column:
    """One CASE: a rule is computed only for texts that all before it let pass."""
    verdict = F.lit(True)
    for rule in reversed(ordered):
        verdict = F.when(rule.rejects(m), F.lit(False)).otherwise(verdict)
    return verdict


def passing(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that no rule rejects; nothing is shuffled."""
    ordered = order_rules(docs, rules, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.where(let(words(text), lambda w: _verdict(ordered, lambda name: MEASURES[name](text, w))))


def quality_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id",
                    text_col: str = "text", measures: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: id, the ``measures`` asked for, kept.

    kept is false when any rule rejects the text. A null or empty text has no words, and the
    rule on few words rejects it. Repeated rows and null ids get rows of their own; other
    columns are not looked at; an empty table gives an empty one.

    The rules form one CASE in the order of ``order_rules``: a rule is computed only for
    texts that all before it let pass. A measure that the caller wants for every row is
    computed once, and the rules read it.
    """
    ordered = order_rules(docs, rules, text_col)
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    df = base.withColumn("words", words(F.col("text")))
    df = df.select("doc_id", "text", "words", *[_inline(x).alias(x) for x in measures])
    m = lambda name: F.col(name) if name in measures else _inline(name)
    return df.select("doc_id", *measures, _verdict(ordered, m).alias("kept"))
