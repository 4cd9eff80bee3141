"""Ids of whole texts by the tokenizers library, which is asked once for each distinct word."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterable
from itertools import pairwise

import numpy as np


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; it is read there, never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Distinct units kept per Python worker and table, about 200 bytes each.
CACHE_UNITS = 500_000
_LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")
_OTHER_BLANK = re.compile(r"[^\S \n]")


def has_even_blanks(text: str) -> bool:
    """Whether all blanks are single ones or single line feeds between other characters."""
    return (text.strip() == text and "  " not in text and "\n\n" not in text and " \n" not in text
            and "\n " not in text and not _OTHER_BLANK.search(text))


# Letters of one case mapping each, which no normal form changes: a word of these alone is one
# word of either tokenizer's pattern.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+").fullmatch


def byte_letters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one above 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in printable else chr(256 + extra))
        extra += b not in printable
    return out


BYTE_LETTERS = dict(enumerate(byte_letters()))


# A unit, with or without its blank, of characters whose class in the byte tokenizer's pattern
# no edition of Unicode changes.
_PLAIN_UNIT = re.compile(" ?[!-~À-ÖØ-öø-ɏ]+").fullmatch
_PLAIN_TEXT = re.compile("[!-~À-ÖØ-öø-ɏ \n]*").fullmatch


def _ids_are_ranks(model: dict) -> bool:
    """Whether the ids are in the order of the merges."""
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    return all(a < b for a, b in pairwise(merged))


def ranked(file: dict, lone_blanks: bool = False):  # noqa: ANN201
    """The same byte-level vocabulary as an encoder by ranks, which is several times as fast;
    none where the ids are no ranks. With ``lone_blanks`` it is for texts in which a line feed
    may meet a blank after it, but no other blanks meet."""
    import tiktoken

    if not _ids_are_ranks(file["model"]):
        return None
    added = {x["content"] for x in file["added_tokens"]}
    byte_of = {c: b for b, c in BYTE_LETTERS.items()}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in file["model"]["vocab"].items() if t not in added}
    # Fixed value: the pattern of this kind of vocabulary. Of several blanks it leaves the last to
    # what follows; looking ahead for that costs time.
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|" + (r"\s" if lone_blanks else r"\s+(?!\S)|\s+")
    return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


# A word whose letters have one small form each, which in UTF-8 is 32 above the capital's last
# byte for the last letter of the word; a full stop or comma after it is a word of its own.
_SMALL_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-þ]*[A-Za-zÀ-ÖØ-Þà-öø-þ][.,]?").fullmatch


def ranked_words(file: dict):  # noqa: ANN201
    """A vocabulary of small letters that marks the ends of words as an encoder by ranks.

    A word's last letter is a capital in place of the mark, so words need nothing between them.
    Gives the encoder and for each id whether it ends a word; none where the ids are no ranks.
    """
    import tiktoken

    end = file["model"].get("end_of_word_suffix")
    if not end or not _ids_are_ranks(file["model"]):
        return None
    byte_of = {c: b for b, c in BYTE_LETTERS.items()}
    added = {x["content"] for x in file["added_tokens"]}
    inner = {*b"abcdefghijklmnopqrstuvwxyz", 0xC3, 0x9F, *range(0xA0, 0xBF)} - {0xB7}
    ranks, ends = {}, np.zeros(1 << 16, bool)
    for token, i in file["model"]["vocab"].items():
        if token in added:
            continue
        marked = token.endswith(end)
        own = bytes(byte_of[c] for c in token.removesuffix(end))
        if marked and own in (b".", b","):
            ranks[own], ends[i] = i, True
            continue
        if not inner.issuperset(own) or marked and own[-1] in (0xC3, 0x9F):
            continue
        ranks[own[:-1] + bytes([own[-1] - 32]) if marked else own] = i
        ends[i] = marked
    if {b".", b","} - ranks.keys():
        return None
    return tiktoken.Encoding("words", pat_str="[a-zß-öø-þ]*[A-ZÀ-ÖØ-Þ]|[.,]", mergeable_ranks=ranks, special_tokens={}), ends


def split_dropping(text: str) -> list[str]:
    """Units for a tokenizer that drops blanks: no word of its pattern spans one."""
    return text.replace("\n", " ").split(" ")


class UnitCache:
    """Values of units of text, made in bulk for those not seen lately."""

    def __init__(self, make: Callable[[list[str]], list[bytes]], most: int = CACHE_UNITS) -> None:
        self._make, self._most = make, most
        self._known: dict[str, bytes] = {}

    def over(self, units: Iterable[list[str]]) -> dict[str, bytes]:
        """A table that holds all units of these lists."""
        wanted = set().union(*units)
        new = list(wanted.difference(self._known))
        if len(self._known) + len(new) > self._most:
            self._known, new = {}, list(wanted)
        self._known.update(zip(new, self._make(new), strict=True))
        return self._known


class Encoder:
    """``encode`` gives each text's ids as little-endian 16-bit numbers, as the library would.

    Texts are cut into units only where that changes no id; the library encodes each distinct
    unit once in a while, many at a time with a special token between them.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        if self._library.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.keeps_blanks = file["pre_tokenizer"]["type"] == "ByteLevel"
        self._tokenize = self._library.model.tokenize
        # Special tokens are the library's: units that may hold one are not encoded by ranks.
        marked = all("<|" in x["content"] for x in file["added_tokens"])
        self._ranked = ranked(file, lone_blanks=True) if self.keeps_blanks and marked else None
        self._ranked_words = None if self.keeps_blanks else ranked_words(file)
        if self._ranked is not None:
            self._feed = self._ranked.encode_ordinary("\n")[0]
        self._border, self._border_id = file["added_tokens"][-1]["content"], file["added_tokens"][-1]["id"]
        self._words = UnitCache(self._bulk)
        # One table in place of two where most units are encoded by ranks.
        self._units = UnitCache(self._stems) if self._ranked_words is None else UnitCache(self._plain_units, 2 * CACHE_UNITS)

    def _ask(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u2") for x in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_ranks(self, units: list[str]) -> list[bytes]:
        """Units with a line feed between them, which is a token of its own before a unit with
        or without its blank, and which no unit holds."""
        ids = np.array(self._ranked.encode_ordinary("\n".join(units)), "<u2")
        cuts = (2 * np.flatnonzero(ids == self._feed)).tolist()
        whole = ids.tobytes()
        return [whole[a:b] for a, b in zip([0, *[c + 2 for c in cuts]], [*cuts, len(whole)], strict=True)]

    def _words_by_ranks(self, units: list[str]) -> list[bytes]:
        """Units of a word and perhaps a full stop or comma."""
        encoding, ends = self._ranked_words
        points = [x[-1] in ".," for x in units]
        text = "".join([x[:-2].lower() + x[-2].upper() + x[-1] if p else x[:-1].lower() + x[-1].upper()
                        for x, p in zip(units, points, strict=True)])
        ids = np.array(encoding.encode_ordinary(text), "<u2")
        words = np.flatnonzero(ends[ids])
        cuts = (2 * words[np.cumsum(np.array(points, np.int64) + 1) - 1] + 2).tolist()
        whole = ids.tobytes()
        return [whole[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]

    def _plain_units(self, units: list[str]) -> list[bytes]:
        """Units of a tokenizer that drops blanks: most by ranks, none of these kept as words too."""
        odd = [x for x in units if not _SMALL_WORD(x)]
        made = dict(zip(odd, self._stems(odd), strict=True))
        plain = [x for x in units if x not in made]
        for at in range(0, len(plain), 2000):
            block = plain[at:at + 2000]
            made.update(zip(block, self._words_by_ranks(block), strict=True))
        return [made[x] for x in units]

    def _word(self, word: str) -> bytes:
        """Ids of one word of letters: the library's model without its pattern."""
        if self.keeps_blanks:
            model_word = word if word.isascii() else word.encode().decode("latin-1")
            model_word = model_word.translate(BYTE_LETTERS)
        else:
            model_word = word.lower()
            if not word.isascii():
                model_word = model_word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return array("H", [t.id for t in self._tokenize(model_word)]).tobytes()

    def _bulk(self, units: list[str]) -> list[bytes]:
        start = 1 if self.keeps_blanks else 0
        out: list[bytes | None] = [None] * len(units)
        if self._ranked is None:
            out = [self._word(x) if _LETTERS(x, start if x[:1] == " " else 0) else None for x in units]
        else:
            plain = [i for i, x in enumerate(units) if _PLAIN_UNIT(x) and "<|" not in x]
            for at in range(0, len(plain), 2000):
                found = self._by_ranks([units[i] for i in plain[at:at + 2000]])
                for i, x in zip(plain[at:at + 2000], found, strict=True):
                    out[i] = x
        rest = [i for i, ids in enumerate(out) if ids is None]
        for at in range(0, len(rest), 500):
            block = [units[i] for i in rest[at:at + 500]]
            joined = self._border.join(block)
            if joined.count("<|") > len(block) - 1:  # a unit may hold a special token itself
                found = [x.tobytes() for x in self._ask(block)]
            else:
                ids = self._ask([joined])[0]
                whole = ids.tobytes()
                cuts = (2 * np.flatnonzero(ids == self._border_id)).tolist()
                found = [whole[a:b] for a, b in zip([0, *[c + 2 for c in cuts]], [*cuts, len(whole)], strict=True)]
            for i, x in zip(rest[at:at + 500], found, strict=True):
                out[i] = x
        return out

    def _stems(self, units: list[str]) -> list[bytes]:
        """Units by their words: a full stop or comma after a letter or digit is a word of its own.

        But not after İ, whose small form ends with a mark that is no letter.
        A unit stands for a blank and its characters where the tokenizer keeps blanks.
        """
        blank = " " if self.keeps_blanks else ""
        split = [[blank + x[:-1], x[-1]] if x[-1:] in (".", ",") and x[-2:-1].isalnum() and x[-2] != "İ" else [blank + x]
                 for x in units]
        known = self._words.over(split)
        return [b"".join([known[w] for w in x]) for x in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.keeps_blanks:
            split = [split_dropping(x) for x in texts]
            known = self._units.over(split)
            return [b"".join(map(known.__getitem__, x)) for x in split]
        if self._ranked is None:
            return self._by_units(texts)
        # Ranks take a whole text in less time than its units take to be found in a table.
        plain = [bool(_PLAIN_TEXT(x)) and "<|" not in x and has_even_blanks(x) for x in texts]
        odd = iter(self._by_units([x for x, p in zip(texts, plain, strict=True) if not p]))
        whole = self._ranked.encode_ordinary
        return [array("H", whole(x)).tobytes() if p else next(odd) for x, p in zip(texts, plain, strict=True)]

    def _by_units(self, texts: list[str]) -> list[bytes]:
        # Lines of units. The pattern takes a blank between two other characters with what
        # follows it and such a line feed by itself, so each unit alone gives the ids that it
        # gives in the text; only the first of a line has no blank before it.
        lines = [[x.split(" ") for x in t.split("\n")] if has_even_blanks(t) else [_LONE_BLANK.split(t)] for t in texts]
        first = self._words.over([[x[0] for x in t] for t in lines] + [["\n"]])
        feed = first["\n"]
        heads = [[first[x[0]] for x in t] for t in lines]
        known = self._units.over([x[1:] for t in lines for x in t]).__getitem__
        return [feed.join([h + b"".join(map(known, x[1:])) for h, x in zip(head, t, strict=True)])
                for head, t in zip(heads, lines, strict=True)]


    def unit_counts(self, texts: list[str]) -> list[tuple[list[str], np.ndarray]]:
        """Each text's units, cut at blanks between two other characters, and their numbers of ids.

        Only for a tokenizer that keeps blanks; a unit but the first stands for a blank and
        its characters.
        """
        split = [t.split(" ") if has_even_blanks(t) else _LONE_BLANK.split(t) for t in texts]
        first = self._words.over([[x[0] for x in split]])
        heads = [len(first[x[0]]) for x in split]
        known = self._units.over([x[1:] for x in split])
        return [(x, np.fromiter([h, *(len(known[u]) for u in x[1:])], np.int64, len(x)) >> 1)
                for h, x in zip(heads, split, strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def in_pieces(texts: list[str | None], chars: int = 1 << 20) -> Iterable[tuple[int, list[str]]]:
    """(number of the first, texts) with about ``chars`` characters at once, null as empty."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= chars:
            yield first, [x or "" for x in texts[first:i + 1]]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, [x or "" for x in texts[first:]]
