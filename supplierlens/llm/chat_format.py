"""Conversations as one marked-up text each, with spans to learn from and attachments by reference."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplierlens.llm.common import let

START, END = "<|im_start|>", "<|im_end|>\n"
#: Fields of a content part; those that its kind does not use are null.
PART = "struct<kind:string,text:string,ref:string,width:long,height:long,seconds:double,pages:long>"


def escape(text: Column) -> Column:
    r"""``text`` without ``<|``: a backslash more in each ``<``, backslashes, ``|``. No control
    string is left, and ``unescape`` takes the same backslash out again."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    r"""A role as one line: backslash as ``\s``, line feed as ``\n``, and no control string."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


@dataclass(frozen=True)
class Visit:
    """What stands in the text for a part of one kind, and the tokens it expands to."""

    shown: Callable[[Column], Column]
    tokens: Callable[[Column], Column]
    attached: bool = True


def placeholder(kind: str) -> str:
    return f"<|{kind}|>"


def visitor(patch: int = 14, audio_rate: float = 25.0, page_tokens: int = 600) -> dict[str, Visit]:
    """Visits by kind. Images expand to one token per patch, audio to ``audio_rate`` tokens a
    second, documents to ``page_tokens`` a page, each to at least one token, also where its
    measures are null; text counts its words."""
    sized = lambda n: F.greatest(F.coalesce(n, F.lit(0)), F.lit(1)).cast("long")
    return {
        "text": Visit(lambda p: escape(F.coalesce(p["text"], F.lit(""))),
                      lambda p: F.coalesce(F.regexp_count(p["text"], F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long"),
                      attached=False),
        "image": Visit(lambda p: F.lit(placeholder("image")),
                       lambda p: sized(F.ceil(p["width"] / patch) * F.ceil(p["height"] / patch))),
        "audio": Visit(lambda p: F.lit(placeholder("audio")), lambda p: sized(F.ceil(p["seconds"] * audio_rate))),
        "document": Visit(lambda p: F.lit(placeholder("document")), lambda p: sized(p["pages"] * page_tokens)),
    }


def text_parts(text: Column) -> Column:
    """A plain text as the only part of its turn."""
    kind, *fields = PART.removeprefix("struct<").removesuffix(">").split(",")
    empty = {f.split(":")[0]: F.lit(None).cast(f.split(":")[1]) for f in fields} | {"text": text}
    return F.array(F.struct(F.lit("text").alias("kind"), *[c.alias(n) for n, c in empty.items()]))


def _visited(parts: Column, visits: dict[str, Visit]) -> Column:
    """Each part's kind, shown text, reference, tokens and whether it is attached. A part of an
    unknown or no kind is an attachment of one token; a null part is left out."""
    def one(p: Column) -> Column:
        shown, tokens, attached = F.lit(placeholder("attachment")), F.lit(1).cast("long"), F.lit(True)
        for kind, v in visits.items():
            of_kind = F.coalesce(p["kind"] == kind, F.lit(False))
            shown = F.when(of_kind, v.shown(p)).otherwise(shown)
            tokens = F.when(of_kind, v.tokens(p)).otherwise(tokens)
            attached = F.when(of_kind, F.lit(v.attached)).otherwise(attached)
        return F.struct(p["kind"].alias("kind"), shown.alias("shown"), p["ref"].alias("ref"),
                        tokens.alias("tokens"), attached.alias("attached"))

    return F.transform(F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull()), one)


def format_chat(conversations: DataFrame, parts: Column | None = None, visits: dict[str, Visit] | None = None,
                learn_from: tuple[str, ...] = ("assistant",), id_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    r"""One row per conversation: conv_id, n_turns, formatted, formatted_chars, loss_spans,
    attachments, n_tokens.

    ``conversations`` has a row per turn; ``parts`` gives a turn's content as an array of PART,
    and without it the text column is the only part. A turn becomes ``<|im_start|>``, its role,
    a line feed, its content, ``<|im_end|>`` and a line feed. Text parts are escaped
    (``escape``), so control strings stand only where the template or a placeholder put them
    and ``read_turns`` gives every text back.

    loss_spans (start, length) are the contents of turns whose role is in ``learn_from``, in
    bytes of UTF-8 from 0, so that a span is cut out without counting characters. attachments
    (turn, part, kind, ref, start, tokens) lists the parts that are not text in order, with the
    byte at which the placeholder stands. n_tokens adds up the tokens of all parts.

    Turns are ordered by turn, null first, then role and content. Null text, role or parts are
    empty; a null id is a conversation of its own. Repeated rows are turns of their own. Other
    columns are not looked at. An empty table gives an empty one. A formatted conversation is
    one value, so one task holds a conversation at a time and it must stay under 2 GB; rows
    are escaped and measured before the one shuffle, by conversation.
    """
    visits = visits or visitor()
    own = F.col(text_col) if parts is None else None
    rows = conversations.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"),
        _visited(text_parts(own) if parts is None else parts, visits).alias("visited"))
    rows = rows.select(
        "conv_id", "turn", "role", F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        F.array_join(F.transform("visited", lambda v: v["shown"]), "").alias("content"),
        F.aggregate("visited", F.lit(0).cast("long"), lambda n, v: n + v["tokens"]).alias("tokens"),
        F.filter(F.transform("visited", lambda v, i: F.struct(
            i.cast("long").alias("part"), v["kind"].alias("kind"), v["ref"].alias("ref"), v["tokens"].alias("tokens"),
            F.when(v["attached"], F.aggregate(F.slice("visited", 1, i), F.lit(0).cast("long"),
                                              lambda n, u: n + F.octet_length(u["shown"]))).alias("at"))),
                 lambda a: a["at"].isNotNull()).alias("attached"))
    rows = rows.withColumn("size", F.octet_length("head") + F.octet_length("content") + len(END))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "content")
    rows = rows.select(
        "conv_id", "role", "content", "tokens", "attached", F.concat("head", "content", F.lit(END)).alias("block"),
        (F.row_number().over(order) - 1).cast("long").alias("n"),
        (F.sum("size").over(order) - F.col("size") + F.octet_length("head")).alias("start"))
    turns = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(
            "n", "block", "start", F.octet_length("content").cast("long").alias("length"),
            F.col("role").isin(*learn_from).alias("learnt"), "attached"))).alias("turns"),
        F.sum("tokens").alias("n_tokens"))
    out = turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["block"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learnt"]),
                    lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: F.transform(t["attached"], lambda a: F.struct(
            t["n"].alias("turn"), a["part"].alias("part"), a["kind"].alias("kind"), a["ref"].alias("ref"),
            (t["start"] + a["at"]).alias("start"), a["tokens"].alias("tokens"))))).alias("attachments"),
        "n_tokens")
    return out.select("conv_id", "n_turns", "formatted", F.char_length("formatted").cast("long").alias("formatted_chars"),
                      "loss_spans", "attachments", "n_tokens")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: role and content. Content of text alone is given
    back as it was; ``read_parts`` takes content with placeholders, which stays escaped."""
    def turn(block: Column, raw: bool) -> Column:
        return let(F.substring_index(block, "\n", 1), lambda role: F.struct(
            unescape_role(role).alias("role"),
            (lambda c: c if raw else unescape(c))(F.substr(
                block, F.char_length(role) + 2,
                F.char_length(block) - F.char_length(role) - F.lit(1 + len(END)))).alias("text")))

    return F.transform(_blocks(formatted), lambda b: turn(b, False))


def _blocks(formatted: Column) -> Column:
    return let(F.split(formatted, r"<\|im_start\|>"), lambda b: F.slice(b, 2, F.size(b)))


def read_parts(formatted: Column) -> Column:
    """For each turn its parts: kind, and the text of a text part."""
    def parts(block: Column) -> Column:
        content = F.replace(F.substr(block, F.char_length(F.substring_index(block, "\n", 1)) + 2), F.lit(END), F.lit(""))
        found = F.regexp_extract_all(content, F.lit(r"<\|\w+\|>|(?:[^<]++|<(?!\|))++"), F.lit(0))
        return F.transform(found, lambda x: F.when(
            x.startswith("<|"), F.struct(F.substr(x, F.lit(3), F.char_length(x) - 4).alias("kind"), F.lit(None).cast("string").alias("text")))
            .otherwise(F.struct(F.lit("text").alias("kind"), unescape(x).alias("text"))))

    return F.transform(_blocks(formatted), parts)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, span after span."""
    return let(formatted.cast("binary"), lambda data: F.array_join(F.transform(
        spans, lambda s: unescape(F.substr(data, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"))), ""))
