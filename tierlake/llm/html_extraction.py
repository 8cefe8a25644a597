"""Main text of web pages by the maximum-scoring subsequence.

A page is read once as a sequence of tags and words. Words score positive and tags negative; a linear scan finds
the contiguous stretch with the greatest sum, and that is the content. All words between two tags have one
score, so the scan goes from text to text. Elements that never are the article (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, comments of readers; by their name, role, class or id) score
nothing and are left out of the text, so that an advert within the article neither ends it nor stays in it.

The weights come from labelled pages: pages whose markup names the article (``article``, ``main``, or a content
class) label their own words and tags. Weights are shrunken log odds of being content, by the innermost block
or link (words) and the tag's name (tags), and by zone: inside of the named article, outside of it, or unknown on
pages that name none, which are learned from the same pages with the names forgotten. Tasks count, the driver gets
one row per zone and tag name of a fixed list. The labelled pages are a bounded sample (``MAX_PAGES``); every
page is then read whole.

Character references are decoded; white space inside of a block counts as one space; blocks follow each other
with one space; inline tags split no words. Unclosed comments and scripts run to the page's end, as in browsers; unclosed
elements end with their parent; end tags without a start are ignored. Work and memory are linear in the page.

A null html counts as empty. Empty pages, and pages without content, give an empty text and 0 characters. Rows are
independent, so repeated rows give equal results, and a null page_id or url passes. An empty table gives no rows.
Without any labelled page the prior weights act. Extra columns are ignored by ``extract``; ``with_main_text``
passes them and replaces ``name`` if it exists.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierlake.llm import text as T

# Fixed values of HTML: names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes title textarea".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead title tr ul".split()
)
INSIDE_PARAGRAPHS = frozenset("br body caption head html legend option optgroup tbody td tfoot th thead title tr".split())
FAMILIES = {name: family for family, names in {
    "list": "ul ol menu dir li", "terms": "dl dt dd", "table": "table caption thead tbody tfoot tr td th", "choice": "select option optgroup",
}.items() for name in names.split()}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"},
    **{part: {"td", "th", "tr", "thead", "tbody", "tfoot", "caption"} for part in ("thead", "tbody", "tfoot")},
}
# What an end tag or a new block within closes nothing outside of, unless it is of a table itself.
SCOPES = frozenset("applet button caption marquee math noscript object select svg td template th".split())
# What is never the article, by element, role, and word of a class or id.
NEVER = frozenset(
    "script style noscript template nav footer aside iframe noembed noframes object svg math button select textarea datalist dialog "
    "audio video canvas applet head title menu search xmp".split()
)
SOFT = frozenset(["form", "header"])  # unless an article stands in it (form) or it stands in an article (header)
NEVER_ROLES = frozenset(
    "navigation contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status banner tablist".split()
)
OF_READERS = frozenset("comment comments commentlist respond replies reply disqus discussion related recommended recommendations".split())
NEVER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adsbygoogle sponsor sponsored promo promotion promoted "
    "banner cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar widget widgets footer masthead topbar toolbar "
    "share sharing social recirc copyright searchbox searchform".split()
)
HEADER_WORDS = frozenset(["header", "head"])  # outside of an article
MODIFIERS = frozenset(["has", "with", "no", "without", "is", "layout"])
CONTENT_WORDS = frozenset("article articlebody content entry post story main".split())
# Levels at which markup names the article; a page counts by its highest.
NONE, NAMED, MAIN, ARTICLE = 0, 1, 2, 3

MAX_PAGES = 2000
INSIDE, OUTSIDE, UNKNOWN = "inside", "outside", "unknown"
WORD, TAG, PROSE = "word", "tag", "prose"
# Share of content among words and tags before any page is seen, and how many counts that is worth.
PRIOR = {
    (INSIDE, WORD): 0.95, (INSIDE, TAG): 0.6, (OUTSIDE, WORD): 0.05, (OUTSIDE, TAG): 0.001,
    (UNKNOWN, WORD): 0.75, (UNKNOWN, TAG): 0.04, (UNKNOWN, PROSE): 0.6,
}
PROSE_TAGS = frozenset("p br h1 h2 h3 h4 h5 h6 blockquote pre img".split())  # tags of running text have a prior of their own
WORTH = 50
# Words stay positive and tags negative, whatever the counts.
BOUNDS = {
    (INSIDE, WORD): (1.0, 4.0), (OUTSIDE, WORD): (0.01, 0.1), (UNKNOWN, WORD): (0.25, 3.0),
    (INSIDE, TAG): (0.001, 0.01), (OUTSIDE, TAG): (1.0, 7.0), (UNKNOWN, TAG): (0.1, 5.0),
}
TAGS = sorted((BLOCKS | {"a", "b", "i", "em", "strong", "span", "img"}) - {"head", "title"})

_MARKUP = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
_ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?)""")
_COMMENT_END = re.compile(r"--!?>")
_CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
KEPT_CLASSES = 4096


@dataclass(slots=True)
class Piece:
    """A text (with its words) or a tag, in page order; ``level`` says which markup around it names the article."""

    kind: str
    key: str
    level: int
    text: str = ""
    n_words: int = 0
    left_out: bool = False
    block: bool = False


@dataclass(slots=True)
class _Open:
    name: str
    out: int  # 0 read, 1 left out unless an article starts within, 2 left out
    level: int
    code: bool
    key: str


class _Classes:
    """What the words of a class or id attribute say, kept for attributes that recur."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[frozenset, frozenset]] = {}

    def words(self, value: str) -> tuple[frozenset, frozenset]:
        """(single words, whole names without separators)"""
        found = self.known.get(value)
        if found is None:
            words: set[str] = set()
            names = html.unescape(value).split()
            for name in names:
                own = [w.lower() for w in _CAMEL.findall(name)]
                if not own or own[0] not in MODIFIERS:
                    words.update(own)
            found = frozenset(words), frozenset(n.lower() for n in names)
            if len(self.known) >= KEPT_CLASSES:
                self.known.clear()
            if len(value) <= 200:
                self.known[value] = found
        return found


_classes = _Classes()


def _attributes(page: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes from ``at`` to the tag's end, the first of each name, and the place behind the tag."""
    found: dict[str, str] = {}
    while (m := _ATTRIBUTE.match(page, at)) and m.end() > at:
        at = m.end()
        if m[1]:
            return found, at
        if m[2]:
            found.setdefault(m[2].lower(), m[3] or m[4] or m[5] or "")
    return found, len(page)


def _standing(name: str, attributes: dict[str, str], parent: _Open) -> tuple[int, int]:
    """(left out, level) of an element that starts within ``parent``."""
    out, level = parent.out, parent.level
    if name in ("html", "body"):
        return out, level
    words, names = _classes.words(f"{attributes.get('class', '')} {attributes.get('id', '')}") if attributes else (frozenset(), frozenset())
    role = attributes.get("role", "").strip().lower()
    own = 0
    if name in NEVER or "hidden" in attributes:
        own = 2
    elif name == "header":
        own = 0 if level > NONE else 1
    elif parent.code:
        own = 0
    elif words & OF_READERS:
        own = 2
    elif name not in ("article", "main"):
        if name in SOFT or role in NEVER_ROLES or words & NEVER_WORDS:
            own = 1
        elif words & HEADER_WORDS and level == NONE and not words & CONTENT_WORDS:
            own = 1
    if own == 0:
        if name == "article" or attributes.get("itemprop", "").lower() == "articlebody":
            level = ARTICLE
        elif name == "main" or role == "main":
            level = max(level, MAIN)
        elif words & CONTENT_WORDS and (names & CONTENT_WORDS or len(words & (CONTENT_WORDS | {"body", "text"})) > 1):
            level = max(level, NAMED)
        if out == 1 and name in ("article", "main"):
            out = 0
    return max(out, own), level


SCOPE = "/scope"


@functools.cache
def _groups_of(name: str) -> tuple[str, ...]:
    family = FAMILIES.get(name)
    return (name, *([f"/{family}"] if family else []), *([SCOPE] if name in SCOPES else []))


def _groups(name: str) -> tuple[str, ...]:
    """Under which keys the place of an open element is kept; names hold no slash."""
    return _groups_of(name) if name in BLOCKS or name in SCOPES or name in FAMILIES else (name,)


def pieces(page: str) -> Iterator[Piece]:
    """Texts and tags of a page in order."""
    stack = [_Open("", 0, NONE, False, "")]
    places: defaultdict[str, list[int]] = defaultdict(list)  # of open elements, by name, family, and whether they are scopes
    links = 0

    def close(upto: int) -> None:
        nonlocal links
        while len(stack) > upto:
            for group in _groups(stack.pop().name):
                places[group].pop()

    def reach(name: str) -> int:
        """Where the nearest open element of a name is, if it can be closed from here, else 0."""
        at = places[name][-1] if places[name] else 0
        within = places[SCOPE][-1] if places[SCOPE] and FAMILIES.get(name) != "table" else 0
        return at if at >= within else 0

    def shown(text: str) -> Piece:
        top = stack[-1]
        text = html.unescape(text) if "&" in text else text
        return Piece(WORD, "a" if links else top.key, top.level, text, len(text.split()), top.out > 0)

    at, size = 0, len(page)
    while at < size:
        m = _MARKUP.search(page, at)
        if m is None:
            yield shown(page[at:])
            return
        if m.start() > at:
            yield shown(page[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            if m[0] == "<!--":
                if page.startswith(">", at) or page.startswith("->", at):
                    at = page.index(">", at) + 1
                else:
                    end = _COMMENT_END.search(page, at)
                    at = end.end() if end else size
            else:
                end = page.find(">", at)
                at = end + 1 if end >= 0 else size
            continue
        name = name.lower()
        if page.startswith(">", at):
            attributes, at = {}, at + 1
        else:
            attributes, at = _attributes(page, at)
        block = name in BLOCKS
        if m[1]:
            before = stack[-1]
            if name == "a":
                links = 0
            if start := reach(name):
                close(start)
            if block or name == "a":
                yield Piece(TAG, name, min(before.level, stack[-1].level), left_out=before.out > 0, block=block)
            continue
        if block and name not in INSIDE_PARAGRAPHS and (start := reach("p")):
            close(start)
        closes = CLOSES.get(name, ())
        same = places["/" + FAMILIES[name]] if closes else ()
        while same and stack[same[-1]].name in closes:
            close(same[-1])
        if block:
            links = 0
        elif name == "a":
            links = 1
        out, level = _standing(name, attributes, stack[-1])
        parent = stack[-1]
        if block or name in ("a", "img"):
            yield Piece(TAG, name, min(parent.level, level), left_out=out > 0, block=block)
        if name in VOID:
            continue
        if block or name in RAW or out != parent.out or level != parent.level or places[name] or name == "code":
            code = parent.code or name in ("pre", "code")
            stack.append(_Open(name, out, level, code, name if block else parent.key))
            for group in _groups(name):
                places[group].append(len(stack) - 1)
        if name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            at = end.start() if end else size


@dataclass
class Weights:
    """Scores by (zone, kind, tag name); prior scores where a name was not counted."""

    of: dict[tuple[str, str, str], float] = field(default_factory=dict)

    def score(self, zone: str, piece: Piece) -> float:
        known = self.of.get((zone, piece.kind, piece.key))
        if known is None:
            known = weight(zone, piece.kind, piece.key, 0, 0)
        return known * piece.n_words if piece.kind == WORD else known


def weight(zone: str, kind: str, key: str, content: int, other: int) -> float:
    """Shrunken log odds of being content, kept above 0 for words and below 0 for tags."""
    prose = zone == UNKNOWN and kind == TAG and key in PROSE_TAGS
    prior, (least, most) = PRIOR[zone, PROSE if prose else kind], BOUNDS[zone, kind]
    odds = math.log((content + WORTH * prior) / (other + WORTH * (1 - prior)))
    return min(max(odds, least), most) if kind == WORD else -min(max(-odds, least), most)


def zones(parts: list[Piece]) -> tuple[int, list[str]]:
    """The highest level at which the page's markup names its article, and the zone of each piece."""
    named = max((p.level for p in parts if p.n_words and not p.left_out), default=NONE)
    if named == NONE:
        return named, [UNKNOWN] * len(parts)
    return named, [INSIDE if p.level >= named else OUTSIDE for p in parts]


def labelled(page: str) -> Counter[tuple[str, str, str, bool]]:
    """Counts of (zone, kind, tag name, is content) of a page whose markup names its article; else none."""
    parts = list(pieces(page))
    named, places = zones(parts)
    counts: Counter[tuple[str, str, str, bool]] = Counter()
    if named == NONE:
        return counts
    for part, zone in zip(parts, places, strict=True):
        content = zone == INSIDE and not part.left_out
        n = part.n_words if part.kind == WORD else 1
        # Names outside of the fixed list, and the outermost text, have the prior.
        if part.key in _TAGS and n:
            if not part.left_out:
                counts[zone, part.kind, part.key, content] += n
            if part.key not in ("article", "main"):
                counts[UNKNOWN, part.kind, part.key, content] += n
    return counts


_TAGS = frozenset(TAGS)


def best_stretch(scores: Iterable[float]) -> tuple[int, int]:
    """Start and end (exclusive) of the contiguous stretch with the greatest positive sum; the first of equals, else (0, 0)."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    return found


def main_text(page: str, weights: Weights) -> str:
    """The text of the best stretch, without what is left out."""
    parts = list(pieces(page))
    _, places = zones(parts)
    start, end = best_stretch(0.0 if p.left_out else weights.score(z, p) for p, z in zip(parts, places, strict=True))
    found = []
    for part in parts[start:end]:
        if part.block:
            found.append(" ")
        elif part.kind == WORD and not part.left_out:
            found.append(part.text)
    return " ".join("".join(found).split())


def _texts(column: pa.Array) -> Iterator[str]:
    """Strings of a column, few at a time; null counts as empty."""
    for at in range(0, len(column), 64):
        yield from (x or "" for x in column.slice(at, 64).to_pylist())


def learn(pages: DataFrame, max_pages: int = MAX_PAGES) -> Weights:
    """Weights from the pages that name their article among the ``max_pages`` with the smallest hashes of page_id."""
    known = pages.select("page_id", F.col("html").cast("string").alias("html")).filter("page_id is not null and html is not null")
    chosen = known.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(max_pages)
    # An id that repeats counts as often as it does; tasks return counts, so the driver's part does not grow with it.
    sample = known.join(F.broadcast(chosen.distinct()), "page_id", "left_semi")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[tuple[str, str, str, bool]] = Counter()
        for batch in batches:
            for page in _texts(T.column(batch, "html")):
                total.update(labelled(page))
        kinds = [pa.string(), pa.string(), pa.string(), pa.bool_()]
        arrays = [pa.array([key[k] for key in total], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(list(total.values()), pa.int64())], ["zone", "kind", "key", "content", "n"])

    counts = sample.mapInArrow(counted, "zone string, kind string, key string, content boolean, n bigint")
    rows = counts.groupBy("zone", "kind", "key").pivot("content", [True, False]).agg(F.sum("n")).collect()
    return Weights({(r.zone, r.kind, r.key): weight(r.zone, r.kind, r.key, r["true"] or 0, r["false"] or 0) for r in rows})


def _read(pages: DataFrame, weights: Weights, kept: list[str], name: str) -> DataFrame:
    """Columns ``kept`` of the rows and the main text of ``html``."""
    source = "_html" if "html" in kept else "html"
    given = pages.select(*kept, F.col("html").cast("string").alias(source))
    out = given.select(*kept, F.lit(None).cast("string").alias(name))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array((main_text(page, weights) for page in _texts(T.column(batch, source))), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], [*kept, name])

    return given.mapInArrow(read, out.schema)


def with_main_text(pages: DataFrame, weights: Weights, name: str = "text") -> DataFrame:
    """The rows with all their columns and the main text of ``html``."""
    return _read(pages, weights, [c for c in pages.columns if c != name], name)


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    found = _read(pages, weights, ["page_id", "url"], "text")
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))
