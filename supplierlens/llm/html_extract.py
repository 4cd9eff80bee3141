"""Main text of web pages: the contiguous region whose words outweigh its tags."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplierlens.llm.common import written

#: Labelled pages that the weights are fitted on at most. A page is labelled when it marks its
#: own content with exactly one <article> or <main>. The first by a hash of the page's id and
#: url are taken; every page is extracted with the same weights.
LABELLED_PAGES = 600
#: Bound of a weight, and pseudo-counts that hold it near its prior while a feature is rare.
MOST, PRIOR_COUNT = 4.0, 3.0
#: Weight of a class or id that is a noise or a content word alone, before any page is seen, and
#: the evidence of all names of a block below which the block is no content.
NOISE_NAME, CONTENT_NAME, NOISE_BELOW = -3.0, 1.5, -0.5

# Elements of the HTML standard.
_RAW = {"script", "style", "textarea", "title", "template", "noscript", "iframe", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCKS = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details",
           "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1",
           "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "html", "legend", "li", "main", "menu", "nav",
           "object", "ol", "optgroup", "option", "p", "pre", "search", "section", "select", "summary", "svg", "table",
           "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
_CLOSES_P = _BLOCKS - {"button", "body", "html", "head", "caption", "td", "th", "tr", "tbody", "thead", "tfoot",
                       "option", "optgroup", "legend", "object", "svg", "select"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}}

#: Elements that an open <p> is not looked for beyond.
_SCOPES = {"button", "caption", "object", "table", "td", "th"}
#: Elements and roles that stand for something other than content, and words of a class or id
#: that are evidence of it.
NOISE_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset", "object",
              "svg", "search", "head", "canvas", "audio", "video", "label"}
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog",
               "form", "menu", "menubar", "toolbar"}
NOISE_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "banner",
               "breadcrumb", "breadcrumbs", "comment", "comments", "commentary", "consent", "cookie", "cookies",
               "copyright", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav",
               "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pager", "pagination",
               "popup", "popover", "promo", "promotion", "promoted", "recommended", "related", "replies", "reply",
               "respond", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored",
               "subscribe", "subscription", "teaser", "toolbar", "topbar", "widget", "alert", "toast"}
CONTENT_WORDS = {"article", "content", "entry", "main", "post", "story", "text"}
#: Tags that running text is made of.
_TEXT_TAGS = {"a", "abbr", "b", "blockquote", "br", "cite", "code", "dd", "dl", "dt", "em", "h1", "h2", "h3", "h4", "i",
              "li", "ol", "p", "pre", "q", "small", "span", "strong", "sub", "sup", "table", "tbody", "td", "th", "tr",
              "u", "ul"}
_NEVER_NOISE = {"html", "body", "main", "article"}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass(slots=True)
class Part:
    """A tag (no text) or a run of text of a page, in page order.

    ``feature`` is the tag, or for text the element that it stands in, without the marks that
    pages are labelled by; ``inside`` says that it lies in <article> or <main>, ``noise`` that
    it lies in an element that by its name or role is no content or is hidden, ``breaks`` that
    a tag ends a block or a line. ``named`` are the numbers of the named blocks that hold it.
    """

    feature: str
    text: str
    inside: bool
    noise: bool
    breaks: bool
    named: tuple[int, ...]

    @property
    def words(self) -> int:
        return len(self.text.split())


@dataclass(slots=True)
class _Block:
    """An open block. ``number`` is set where it has a class or id."""

    name: str
    noise: bool
    inside: bool
    named: tuple[int, ...]
    number: int = 0
    holds_content: bool = False
    holds_title: bool = False
    paragraphs: int = 0


#: The names of a block: for each class and the id its words in small letters.
Names = list[tuple[str, ...]]


def _attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


def _is_noise(name: str, attributes: dict[str, str]) -> bool:
    """No content by its element or role, or hidden."""
    if name in _NEVER_NOISE:
        return False
    if ("hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
            or _HIDDEN.search(attributes.get("style", ""))):
        return True
    return name != "form" and (name in NOISE_TAGS or attributes.get("role", "").lower() in NOISE_ROLES)


def _names(name: str, attributes: dict[str, str]) -> Names:
    """The names of a block. A form is one by its element, unless it wraps the page."""
    if name in _NEVER_NOISE:
        return []
    given = (attributes.get("class", "") + " " + attributes.get("id", "")).split()
    found = [tuple(w.lower() for w in _NAME_WORDS.findall(x)) for x in given]
    return [("form",)] if name == "form" else [x for x in found if x]


def parts(page: str) -> tuple[list[Part], dict[int, Names]]:
    """The page as tags and texts, and the names of its named blocks.

    Comments, declarations and raw-text elements are left out, and so are the names of blocks
    that wrap the content: an article or main element, or a title and several paragraphs.
    """
    out: list[Part] = []
    stack = [_Block("", False, False, ())]
    names: dict[int, Names] = {}
    made = at = 0

    def place(block: _Block) -> str:
        parent = stack[-2].name if block.name in ("p", "li") and len(stack) > 1 else ""
        element, parent = ("div" if x in ("article", "main") else x for x in (block.name, parent))
        return f"text:{element} in {parent}" if parent else f"text:{element}"

    def add(feature: str, piece: str, block: _Block, breaks: bool) -> None:
        out.append(Part(feature, piece, block.inside, block.noise, breaks, block.named))

    def text(piece: str) -> None:
        if piece:
            add(place(stack[-1]), html.unescape(piece) if "&" in piece else piece, stack[-1], False)

    def close(k: int) -> None:
        while len(stack) > k:
            block = stack.pop()
            if block.number and (block.holds_content or block.holds_title and block.paragraphs >= 3):
                del names[block.number]
            top = stack[-1]
            top.holds_content |= block.holds_content
            top.holds_title |= block.holds_title
            top.paragraphs += block.paragraphs

    def open_p() -> int:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name == "p":
                return k
            if stack[k].name in _SCOPES:
                break
        return 0

    while match := _TOKEN.search(page, at):
        text(page[at:match.start()])
        at = match.end()
        name = (match["name"] or match["name2"] or "").lower()
        if not name:
            if match[0].startswith("<![CDATA["):
                text(match[0][9:].removesuffix("]]>"))
            continue
        ends = bool(match["end"] or match["end2"])
        if name in _RAW:
            if not ends:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
            continue
        block = name in _BLOCKS
        feature = "div" if name in ("article", "main") else name
        if ends:
            if block:
                k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
                if k:
                    close(k)
            add("/" + feature, "", stack[-1], block)
            continue
        if not block:
            add(feature, "", stack[-1], name in ("br", "hr"))
            continue
        if name in _CLOSES_P and (k := open_p()):
            close(k)
        if name in _SIBLINGS and stack[-1].name in _SIBLINGS[name]:
            close(len(stack) - 1)
        top = stack[-1]
        attributes = _attributes(match["attrs"] or match["attrs2"] or "")
        own = _names(name, attributes)
        if own:
            made += 1
            names[made] = own
        marks = name in ("article", "main")
        stack.append(_Block(
            name, top.noise or _is_noise(name, attributes), top.inside or marks, (*top.named, made) if own else top.named,
            number=made if own else 0, holds_content=marks, holds_title=name == "h1", paragraphs=int(name == "p")))
        add(feature, "", stack[-1], True)
    text(page[at:])
    close(1)
    return out, names


def _name_prior(word: str) -> float:
    return NOISE_NAME if word in NOISE_WORDS or word == "form" else CONTENT_NAME if word in CONTENT_WORDS else 0.0


def _evidence(names: Names, weights: dict[str, float]) -> float:
    """What the names of a block say: the mean of those that say anything.

    A name weighs the mean of its words, so that share-price says less than share; its content
    words count for nothing beside a noise word, since post-comments are comments.
    """
    said = []
    for name in names:
        own = [weights.get("name:" + w, _name_prior(w)) for w in name]
        weight = sum(min(x, 0.0) if min(own) < 0 else x for x in own) / len(own)
        if weight:
            said.append(weight)
    return sum(said) / len(said) if said else 0.0


def _noise_blocks(all_parts: list[Part], names: dict[int, Names], weights: dict[str, float]) -> set[int]:
    """Numbers of the blocks that are no content by the evidence of their names.

    A block of mixed names that holds over four fifths of the words that could be content is
    content whatever its names say; where the page marks its content, only one inside the mark.
    """
    against = {k: e for k, v in names.items() if (e := _evidence(v, weights)) < NOISE_BELOW}
    held = dict.fromkeys(against, 0)
    marked = free = 0
    for part in all_parts:
        if part.noise or not (n := part.words):
            continue
        marked += n * part.inside
        holders = [k for k in part.named if k in against]
        free += n * (not holders)
        for k in holders:
            held[k] += n
    inside = {k for p in all_parts if p.inside for k in p.named} if marked else set(against)
    return {k for k, e in against.items()
            if e <= NOISE_NAME or held[k] <= 4 * free or k not in inside}


def _prior(feature: str) -> float:
    """Weight of a word, tag or name before any page is seen: words positive, tags negative."""
    kind, colon, place = feature.partition(":")
    if kind == "name":
        return _name_prior(place)
    if not colon:
        return -0.2 if feature.lstrip("/") in _TEXT_TAGS else -1.0
    return 1.0 if place.partition(" in ")[0] in ("p", "h1", "h2", "h3", "blockquote", "pre") else 0.5


def counts(page: str) -> Counter[tuple[str, bool]]:
    """How often each feature of a labelled page stands inside and outside its content.

    Places are counted by words, names once a page and side. The mark says nothing of a block
    inside it whose names stand for noise, as adverts stand in articles.
    """
    found: Counter[tuple[str, bool]] = Counter()
    seen: set[tuple[str, bool]] = set()
    all_parts, names = parts(page)
    noise = {k for k, v in names.items() if _evidence(v, {}) < NOISE_BELOW}
    for part in all_parts:
        if part.noise or part.inside and not noise.isdisjoint(part.named):
            continue
        if not part.feature.startswith("text:"):
            found[part.feature, part.inside] += 1
        elif n := part.words:
            found[part.feature, part.inside] += n
            seen.update(("name:" + w, part.inside) for k in part.named if k in names for x in names[k] for w in x)
    found.update(seen)
    return found


def fitted(table: list[tuple[str, int, int]]) -> dict[str, float]:
    """Weights from (feature, count inside, count outside): log odds, drawn to the prior.

    Words and names weigh what the labelled pages say; a tag never weighs more than nothing,
    since tags only cost.
    """
    out = {}
    for feature, inside, outside in table:
        prior = _prior(feature)
        n = inside + outside
        odds = math.log((inside + 0.5) / (outside + 0.5))
        weight = (n * odds + PRIOR_COUNT * prior) / (n + PRIOR_COUNT)
        weight = max(-MOST, min(MOST, weight))
        out[feature] = weight if ":" in feature else min(weight, -0.05)
    return out


def fit_weights(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                labelled: int = LABELLED_PAGES) -> dict[str, float]:
    """Weights by feature from at most ``labelled`` labelled pages, counted on the executors.

    Pages are read once: those whose hash lies in a share of the hashes that about four times
    ``labelled`` pages have are counted, and of the labelled ones the first by hash are taken.
    So the pages looked at are as many for a large table as for a small one. Pages alike in id
    and url count once.
    """
    mark = r"(?i)<(article|main)[\s>]"
    total = pages.count()
    hashed = pages.select(F.xxhash64(id_col, url_col).alias("at"), F.col(html_col).alias("html"))
    if total > 4 * labelled:
        last = int(-(1 << 63) + (1 << 64) * (4 * labelled / total))
        hashed = hashed.where(F.col("at") < last)
    sample = (hashed.where(F.regexp_count("html", F.lit(mark)) == 1).groupBy("at").agg(F.min("html").alias("html")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, page in zip(batch.column(0), batch.column(1), strict=True):
                found = counts(page.as_py())
                keys = list(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at.as_py()] * len(keys), pa.int64()), pa.array([k[0] for k in keys], pa.string()),
                     pa.array([found[k] if k[1] else 0 for k in keys], pa.int64()),
                     pa.array([0 if k[1] else found[k] for k in keys], pa.int64())], ["at", "feature", "inside", "outside"])

    each = written(sample.mapInArrow(run, "at long, feature string, inside long, outside long"), "page-features")
    last_taken = each.select("at").distinct().orderBy("at").limit(labelled).agg(F.max("at")).first()[0]
    if last_taken is None:
        return {}
    table = (each.where(F.col("at") <= last_taken)
             .groupBy("feature").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")))
    return fitted([tuple(r) for r in table.collect()])


def _weight(part: Part, noise: bool, gain: float, weights: dict[str, float]) -> float:
    """A tag's weight, or that of all words of a text; ``gain`` is what names say for it.

    Inside a marked content element words count at least 1 and tags cost little, so that a
    list does not end the region. Noise is left out of a region's text and costs next to
    nothing, so that an advert between two paragraphs does not part them.
    """
    is_text = part.feature.startswith("text:")
    n = part.words if is_text else 1
    if noise:
        return 0.0 if part.inside else -0.1 * n
    weight = weights.get(part.feature)
    weight = _prior(part.feature) if weight is None else weight
    if is_text:
        return n * (max(weight, 1.0) if part.inside else weight + gain)
    return max(weight, -0.2) if part.inside else weight


def _region(all_parts: list[Part], noise: list[bool], gains: dict[int, float],
            weights: dict[str, float]) -> tuple[int, int]:
    best, best_range, run, start = 0.0, (0, 0), 0.0, 0
    for i, part in enumerate(all_parts):
        if run <= 0:
            run, start = 0.0, i
        run += _weight(part, noise[i], max((gains.get(k, 0.0) for k in part.named), default=0.0), weights)
        if run > best:
            best, best_range = run, (start, i + 1)
    return best_range


def main_text(page: str, weights: dict[str, float]) -> str:
    """Text of the best contiguous region, blocks in page order joined by one space.

    One scan over the page's words and tags keeps the best sum of weights that ends here and
    the best so far. Words of elements that are no content by element, role or the evidence of
    their names are left out of the region's text. Where no place of a page has a positive
    fitted weight, the weights before fitting decide.
    """
    all_parts, names = parts(page)
    blocks = _noise_blocks(all_parts, names, weights)
    noise = [p.noise or not blocks.isdisjoint(p.named) for p in all_parts]
    gains = {k: max(_evidence(v, weights), 0.0) for k, v in names.items()}
    begin, end = _region(all_parts, noise, gains, weights)
    if begin == end:
        begin, end = _region(all_parts, noise, gains, {})
    return " ".join("".join(
        (" " if all_parts[i].breaks or noise[i] else all_parts[i].text) for i in range(begin, end)).split())


def extract_main_text(pages: DataFrame, weights: dict[str, float] | None = None, id_col: str = "page_id",
                      url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    ``weights`` are fitted on ``pages`` unless given. Null and empty pages have an empty text;
    repeated rows and null ids get rows of their own; other columns are not looked at; an
    empty table gives an empty one. Character references are decoded, blanks become one
    space, and nothing is cut off. Each page is read in one scan in the task that holds it.
    """
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(html_col, F.lit("")).alias("html"))
    fixed = fit_weights(base) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 64) for b in batches for i in range(0, len(b), 64)):
            found = [main_text(x, fixed) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()),
                 pa.array([len(x) for x in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = base.schema
    return base.mapInArrow(run, f"page_id {kinds['page_id'].dataType.simpleString()}, "
                                f"url {kinds['url'].dataType.simpleString()}, text string, n_chars long")
