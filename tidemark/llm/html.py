"""Main text of web pages by line-block distribution.

A page becomes lines (its blocks). Text lengths are summed over a sliding window of
lines; where the sum surges, content begins, and where it dives, content ends. Lines
that markup names as something else (menus, forms, notices, comments), and blocks that
repeat the shape of reader comments, have no length. Time is linear in the page.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.arrays import add_columns

# Elements that break lines, that hold no text, and that hold no article text.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul title".split()
)
RAW = set("script style textarea title xmp iframe noembed noframes".split())
SIDE = set("nav header footer aside form button select menu dialog noscript template svg canvas object audio video iframe head".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Words in class, id and role attributes of parts that are no article text.
SIDE_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "copyright dialog disclaimer discussion disqus footer form gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination paginator popup promo promoted promotion related reply replies respond search share sharing sidebar sidebars signup social "
    "sponsor sponsored sponsors subscribe subscription toolbar topbar widget widgets complementary contentinfo alert alerts comentarios commentaires kommentare".split()
)

# Words that, beside those, may make up a name of such a part ("comments-area"), and words of its state.
PLACE_WORDS = set(
    "area bar block body bottom box button buttons col column container content count entry fixed float global group head heading icon icons id inner inline "
    "item items js latest layout left link links list main media mobile more module outer overlay page panel placeholder post posts primary reader recent right "
    "row secondary section site slot sticky story text title top unit user view wp wrap wrapper article blog email follow google us".split()
)
BOXES = set("article main div section ul ol li".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
COMMENT = re.compile(r"""[\s"'=]comments?(?:-(?:body|item|\d+))?(?=[\s"'>]|\Z)""", re.IGNORECASE)
SPACE = re.compile(r"\s+")
_LAST = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE) for name in RAW}


HEADING_WORDS = {"header", "masthead"}  # inside an article these name its own heading
COMMENTS = re.compile(r"(?:\A|\s)(?:comments?|commentlist|comentarios|commentaires|kommentare|replies|respond|discussion|disqus)(?![a-z])", re.IGNORECASE)


def names_side(attributes: str, in_article: bool = False) -> bool:
    """Whether class, id or role names a part that is no article text.

    A whole name must do so: each of its words names such a part or a place on the page.
    """
    words = SIDE_WORDS - HEADING_WORDS if in_article else SIDE_WORDS
    for value in _values(attributes, ("class", "id", "role")):
        for name in value.split():
            parts = [w.lower() for w in WORD.findall(name)]
            if any(w in words for w in parts) and all(w in words or w in PLACE_WORDS or len(w) == 1 for w in parts):
                return True
    return False


def is_hidden(attributes: str) -> bool:
    """Whether the part is hidden by an attribute of its own."""
    return bool(_values(attributes, ("hidden",))) or any(v.lower() == "true" for v in _values(attributes, ("aria-hidden",)))


def _values(attributes: str, kinds: tuple[str, ...]) -> list[str]:
    return [next((g for g in m.groups()[1:] if g is not None), "") for m in ATTRIBUTE.finditer(attributes) if m[1].lower() in kinds]


class Line(NamedTuple):
    """A block of a page: its text, the number of the article around it or 0, whether it is a side part, its link
    characters, the innermost box around it (0: the page), whether it is a heading."""

    text: str
    inside: int
    hidden: bool
    linked: int
    box: int
    heading: bool


class Box(NamedTuple):
    """An element that holds lines [low, high), and the box around it."""

    name: str
    around: int
    low: int
    high: int


def lines_of(page: str) -> tuple[list[Line], list[Box]]:
    """The blocks of a page in order, and its boxes.

    References are decoded after the markup is gone, runs of white space become one
    blank, ends are trimmed; blocks without text are left out. Elements that are never
    closed end with the page or with the block element around them. Elements that by
    their kind or an attribute hold no article text are side parts at once, named ones
    only once it is known what they hold.
    """
    out: list[Line] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, int, int]] = []  # open elements that matter, whether they hide their text, their place in spans, the box around them
    opened: Counter[str] = Counter()  # their names
    boxes: list[list] = [["", 0, 0, None]]
    box, heading = 0, False
    spans: list[list] = []  # [element, first line, end line, named as a side part, named as comments]
    side = article = articles = link = linked = 0

    def flush() -> None:
        nonlocal linked, heading
        if parts:
            text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                out.append(Line(text, articles if article else 0, side > 0, min(linked, len(text)), box, heading))
            parts.clear()
        linked, heading = 0, False

    def close() -> str:
        nonlocal side, article, link, box
        name, hides, span, around = stack.pop()
        opened[name] -= 1
        side -= hides
        article -= name in ("article", "main")
        link -= name == "a"
        if span >= 0:
            spans[span][2] = len(out)
        if name in BOXES:
            boxes[box][3], box = len(out), around
        return name

    def text(piece: str) -> None:
        nonlocal linked
        parts.append(piece)
        if link:
            linked += len(piece.strip())

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCKS or name in SIDE:
            flush()
        if m[1]:
            while opened[name] and close() != name:
                pass
            continue
        if name == "li" and stack and stack[-1][0] == "li":
            close()
        heading = name in HEADINGS
        if name in RAW and not m[3].endswith("/"):
            end = _LAST[name].search(page, at)
            at = end.end() if end else n
            continue
        if name in VOID or m[3].endswith("/"):
            continue
        hides = name in SIDE or (name in BLOCKS or name == "span") and is_hidden(m[3])
        named = not hides and (name in BLOCKS or name == "span") and names_side(m[3], article > 0)
        if name in ("article", "main", "body", "html"):  # their classes describe the page, save for single comments
            hides, named = False, name in ("article", "main") and COMMENT.search(m[3]) is not None
        if name == "header" and article:
            hides = named = False  # the heading of the article itself
        if hides or named or name in BOXES or name in ("a", "span") or name in SIDE:
            if name == "a" and link:
                continue
            span = -1
            if named or name in ("article", "main"):
                span = len(spans)
                spans.append([name, len(out), None, named, named and any(COMMENTS.search(v) for v in _values(m[3], ("class", "id")))])
            stack.append((name, bool(hides), span, box))
            opened[name] += 1
            if name in BOXES:
                boxes.append([name, box, len(out), None])
                box = len(boxes) - 1
            side += bool(hides)
            if name in ("article", "main"):
                articles += not article
                article += 1
            link += name == "a"
    flush()
    closed = [Box(kind, around, low, len(out) if high is None else high) for kind, around, low, high in boxes]
    named = _hide_named(out, spans) if any(s[3] for s in spans) else out
    return _hide_comments(named, closed), closed


# How the first lines of a comment tell its author and time.
WHEN = re.compile(
    r"\b(?:\d{1,2}:\d\d|(?:19|20)\d\d|\d{1,2}[./-]\d{1,2}[./-]\d{2,4}|ago|yesterday|today|(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?\s+\d{1,2}"
    r"|\d{1,2}\.?\s+(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*)\b",
    re.IGNORECASE,
)
LONGEST_BYLINE, LEAST_COMMENTS = 80, 3


def _dated(lines: list[Line]) -> bool:
    """Whether the first lines of a block are those of a comment: one or two short lines with a name and a time, then text."""
    first = lines[0]
    if first.heading or len(first.text) > LONGEST_BYLINE:
        return False
    if WHEN.search(first.text):
        return len(lines) > 1 and WHEN.sub("", first.text).strip(" ,.-|at") != ""
    return len(lines) > 2 and _signed(lines) and len(lines[1].text) <= LONGEST_BYLINE and WHEN.search(lines[1].text) is not None


def _signed(lines: list[Line]) -> bool:
    """Whether a block begins with a line like a name, and text follows."""
    first = lines[0].text
    return len(lines) > 1 and not lines[0].heading and len(first) <= LONGEST_BYLINE // 2 and len(first.split()) <= 4 and first[-1].isalnum() and not first[0].islower()


def _hide_comments(lines: list[Line], boxes: list[Box]) -> list[Line]:
    """The lines with reader comments that only their shape tells as side parts.

    Three or more neighbouring boxes of one kind that each begin with an author and a
    time, or after the article with an author alone, are comments. They must be less than half
    of the page's text, or stand outside of an article with a quarter of their text or more.
    """
    held = [0]
    for line in lines:
        held.append(held[-1] + (0 if line.hidden else len(line.text)))
    size = lambda b: held[b.high] - held[b.low]
    cores = [b for b in boxes if b.name == "article"] or [b for b in boxes if b.name == "main"]
    largest = max(cores, key=size, default=None)
    starts_of = lambda b: [line for line in lines[b.low : min(b.high, b.low + 3)] if not line.hidden]
    groups: dict[tuple[int, str], list[Box]] = {}
    for b in boxes[1:]:
        if size(b):
            groups.setdefault((b.around, b.name), []).append(b)
    side = [0] * (len(lines) + 1)
    for group in groups.values():
        first = starts_of(largest) if largest in group else []
        core = None if first and _dated(first) else largest  # a comment can be the largest article there is
        group = [b for b in group if not (core and b.low <= core.low and core.high <= b.high)]
        if len(group) < LEAST_COMMENTS:
            continue
        low, high = group[0].low, group[-1].high
        after = core is not None and low >= core.high
        starts = [starts_of(b) for b in group]
        if not all(s and (_dated(s) or after and _signed(s)) for s in starts):
            continue
        total = sum(map(size, group))
        beside = core is not None and (low >= core.high or high <= core.low)
        if 2 * total < held[-1] or beside and 4 * size(core) >= total:
            for b in group:
                side[b.low] += 1
                side[b.high] -= 1
    out, depth = [], 0
    for line, change in zip(lines, side):
        depth += change
        out.append(line._replace(hidden=True) if depth else line)
    return out


def _hide_named(lines: list[Line], spans: list[list]) -> list[Line]:
    """The lines with those of named elements as side parts.

    A name does not make an element a side part if the largest article or main of the
    page stands in it, nor if more than half of the page's text does and that article is
    around it or has less than a quarter of its text. Comments beside an article are
    always side parts.
    """
    held = [0]
    for t, inside, hidden, linked, *_ in lines:
        held.append(held[-1] + (0 if hidden else len(t) if inside else len(t) - linked))
    spans = [[kind, low, len(lines) if high is None else high, *names] for kind, low, high, *names in spans]
    size = lambda s: held[s[2]] - held[s[1]]
    covered = [0] * (len(lines) + 1)  # by comments
    for _, low, high, _, comments in spans:
        if comments:
            covered[low] += 1
            covered[high] -= 1
    for i in range(len(lines)):
        covered[i + 1] += covered[i]
    found = [s for s in spans if s[0] in ("article", "main") and not s[3] and size(s) and not covered[s[1]]]
    cores = [max(own, key=size) for own in ([s for s in found if s[0] == kind] for kind in ("article", "main")) if own]
    side = [0] * (len(lines) + 1)
    for s in spans:
        _, low, high, named, comments = s
        if not named or any(low <= c[1] and c[2] <= high for c in cores):
            continue
        around = any(c[1] <= low and high <= c[2] for c in cores)
        most = 2 * size(s) > held[-1] and (around or all(4 * size(c) < size(s) for c in cores))
        if not most or comments and cores:
            side[low] += 1
            side[high] -= 1
    out, depth = [], 0
    for line, change in zip(lines, side):
        depth += change
        out.append(line._replace(hidden=line.hidden or depth > 0))
    return out


RAISE = 8


def main_lines(lines: list[Line], boxes: list[Box], window: int = 3, surge: float = 0.25) -> list[str]:
    """The lines between surges and dives of the summed lengths.

    A line's length is its characters outside links, 0 in side parts. Inside an article
    element links count too, and the length is raised by ``RAISE`` times the article's
    characters times their share of the page's: a teaser raises its lines a little, an
    article that is most of the page so much that text around it does not surge. Windows
    do not reach over the edge of an article, and each article surges for itself; the text
    around articles takes in those it surges around. Content begins at a line with a length
    whose window sum reaches ``surge`` of the mean window sum, and ends where the next
    lines are all side parts; between, every line that is no side part is content. Lines
    before a surge (title, author) belong to it if they stand in the same box, or are
    headings below it, and are more than links.
    """
    sizes = [0 if hidden else len(t) if inside else max(0, len(t) - linked) for t, inside, hidden, linked, *_ in lines]
    n, total = len(sizes), sum(sizes)
    if not total:
        return []
    held: dict[int, int] = {}
    for line, size in zip(lines, sizes):
        if line.inside:
            held[line.inside] = held.get(line.inside, 0) + size
    sizes = [size + RAISE * held[line[1]] ** 2 / total if line[1] and size else size for line, size in zip(lines, sizes)]
    sums = [sum(sizes[j] for j in range(i, min(i + window, n)) if lines[j][1] == lines[i][1]) for i in range(n)]
    alive = [s for s in sums if s]
    rise = surge * sum(alive) / len(alive)
    out, reading = [], set()  # the articles being read, and 0 for the text around them
    floor = 0  # lines before are decided
    for i, line in enumerate(lines):
        inside = line.inside
        if line.hidden:
            if all(later.hidden for later in lines[i : i + window]):
                reading.clear()
            continue
        if sizes[i] and sums[i] >= rise:
            if inside not in reading:
                out += _before(lines, boxes, floor, i)
                floor = i
            reading.add(inside)
        if inside in reading or 0 in reading:
            out.append(line.text)
            floor = i + 1
    return out


def _before(lines: list[Line], boxes: list[Box], floor: int, at: int) -> list[str]:
    """The lines from ``floor`` on that lead to the surge at a line; side parts between are passed over."""
    start, found = lines[at], []
    box = boxes[start.box]
    for j in range(at - 1, floor - 1, -1):
        line = lines[j]
        if line.hidden:
            continue
        below = line.heading and start.box and box.low <= j < box.high
        if line.inside != start.inside or not (line.box == start.box or below) or line.linked >= len(line.text):
            break
        found.append(line.text)
    return found[::-1]


def main_text(page: str | None) -> str:
    return "\n".join(main_lines(*lines_of(page))) if page else ""


def extract_main_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """All columns and ``text`` (never NULL) and ``n_chars`` (its code points).

    One pass without a shuffle over whole pages; nothing is capped. NULL, empty pages
    and pages without an article give an empty text; own columns of these names are replaced.
    """

    def build(batch: pa.RecordBatch) -> list:
        texts = [main_text(p) for p in batch.column(html_column).to_pylist()]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return add_columns(pages, build, [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def op5_html_main_text(spark, sf_dir: str) -> DataFrame:
    """Per page: the article's text."""
    from tidemark.llm.tables import table

    return extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")
