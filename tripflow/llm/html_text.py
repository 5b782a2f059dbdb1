"""Main text of web pages by the distribution of their line blocks.

Markup is stripped so that every block element becomes a line. A sliding window
sums the weights of ``WINDOW`` lines; where it surges from nothing a body of
text begins, and where it dives to nothing again the body ends. Bodies whose
windows reach ``SURGE`` are kept, with all their lines.

A line weighs the characters of its text that are no link. Marks weigh lines, too:
where a page marks an article, lines in articles weigh ``MARKED`` times as much and
all others as many times less, so that it takes little text to surge within the
mark, and much without it, but a mark alone neither keeps nor drops a body. Lines of
menus, page headers, footers, sidebars, notices, adverts, forms and reader comments
weigh nothing, and both ends of such a part are followed by empty lines, so that
the window dives there.

A body that does not surge is kept where it belongs to one that does: in the same
container or the same article, such as an ending that a notice cuts off, or, if it
holds headlines only, right before it.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tripflow.llm.common import by_bytes

# Bytes of pages that are handled at a time, unless one is longer.
HELD = 4_000_000
# Lines per window, what a window must reach in a body of text, and how much marks weigh.
WINDOW, SURGE, MARKED = 3, 80, 8

# What never holds text: raw elements with all they contain, comments, declarations.
_RAW = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|iframe|svg|math|object|canvas)\b[^>]*>"
    r".*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_TAG = re.compile(r"<(/?)([a-z][\w:-]*)((?:\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*|/)?)(?:>|\Z)", re.I)
# A tag that the end of the page cut in two.
_CUT = re.compile(r"<(?:/?[a-z][^<>]*|/|!?)\Z", re.I)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# Elements that end the line before and after them.
_BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead tr ul".split()
)
# Elements whose start and end are matched.
_HOLDERS = frozenset(
    "a article aside button dialog div dl fieldset footer form header head li main menu nav ol p section select span "
    "table td ul".split()
)
_ARTICLES = frozenset(("article", "main"))
_HEADLINES = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Holders that are text of the container around them.
_INLINE = frozenset("a li ol p span ul".split())
# Elements, and words of class, id or role, that mark what is not the article.
_ASIDES = frozenset("aside button dialog footer form head header menu nav select".split())
# A word counts as a whole class; the second list also where a class begins with it, as in "comment-list",
# and the third where it ends the class of a page part, as in "site-footer".
_ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement alert aside banner breadcrumb breadcrumbs byline comment comments "
    "complementary consent contentinfo cookie cookies dialog disclaimer discussion disqus footer form gdpr header "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup "
    "promo promoted recommended related remark replies reply respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe subscription toolbar widget".split()
)
_BEGINNINGS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "gdpr menu modal nav navbar navigation newsletter pagination popup promo share sharing sidebar social sponsor "
    "sponsored subscribe toolbar widget".split()
)
_PAGE_PARTS = frozenset("global main page site top bottom left right".split())
_ENDINGS = frozenset("banner footer header menu nav navbar navigation sidebar".split())


@dataclass
class Line:
    text: str
    weight: int
    article: int
    aside: bool
    container: int = 0
    headline: bool = False


def _is_aside(name: str, attributes: str, in_article: bool) -> bool:
    if name in _ARTICLES:
        return False
    if name in _ASIDES and not (name == "header" and in_article):
        return True
    return any(
        _names_aside(word) for values in _NAMED.findall(attributes) for word in "".join(values).lower().split()
    )


def _names_aside(word: str) -> bool:
    """Whether a class, id or role names a part that is not the article."""
    if word in _ASIDE_WORDS:
        return True
    parts = re.split(r"[-_]+", word)
    return len(parts) > 1 and (parts[0] in _BEGINNINGS or parts[0] in _PAGE_PARTS and parts[-1] in _ENDINGS)


def lines_of(page: str) -> list[Line]:
    """The lines of a page in order; empty lines stand where an article, or a part that is none, begins or ends."""
    page = _CUT.sub("", _RAW.sub(" ", page))
    lines: list[Line] = []
    parts: list[str] = []
    linked = 0
    open_holders: list[tuple[str, bool, int, int]] = []  # name, aside, article, container
    article, articles, containers = 0, 0, 0
    headline = False

    def in_aside() -> bool:
        return any(aside for _, aside, _, _ in open_holders)

    def in_link() -> bool:
        return any(name == "a" for name, _, _, _ in open_holders)

    def end_line() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            aside = in_aside()
            container = open_holders[-1][3] if open_holders else 0
            weight = 0 if aside else max(0, len(text) - linked)
            lines.append(Line(text, weight, article, aside, container, headline))
        parts.clear()
        linked = 0

    def gap() -> None:
        lines.extend(Line("", 0, article, True) for _ in range(WINDOW))

    start = 0
    for tag in _TAG.finditer(page):
        chunk = page[start : tag.start()]
        start = tag.end()
        parts.append(chunk)
        if chunk and in_link():
            linked += len(" ".join(chunk.split()))
        closing, name = tag[1] == "/", tag[2].lower()
        if name in _BLOCKS:
            end_line()
            headline = not closing and name in _HEADLINES
        if name not in _HOLDERS:
            continue
        if closing:
            if any(name == own for own, _, _, _ in open_holders):
                before, of = in_aside(), article
                if before and name not in _BLOCKS:
                    end_line()
                while True:
                    own, _, outer, _ = open_holders.pop()
                    article = outer
                    if own == name:
                        break
                if before and not in_aside() or of and not article:
                    gap()
            continue
        if name in ("p", "li"):  # these need no end
            while open_holders and open_holders[-1][0] in (name, "a", "span"):
                open_holders.pop()
        aside = _is_aside(name, tag[3], article > 0)
        if name in _ARTICLES:
            # An article ends whatever was left open before it.
            if in_aside() and name == "main" or not any(own in _ARTICLES for own, _, _, _ in open_holders):
                open_holders = [(own, False, outer, within) for own, _, outer, within in open_holders]
        if aside and not in_aside():
            if name not in _BLOCKS:
                end_line()
            gap()
        container = open_holders[-1][3] if open_holders else 0
        if name not in _INLINE:
            containers += 1
            container = containers
        open_holders.append((name, aside, article, container))
        if name in _ARTICLES and article == 0:
            gap()
            articles += 1
            article = articles
    parts.append(page[start:])
    end_line()
    return lines


@dataclass
class Body:
    """Lines from a surge to the dive after it, and the highest sum of a window among them."""

    first: int
    last: int
    peak: int


def weights_of(lines: list[Line], marked: int = MARKED) -> list[int]:
    """What the lines weigh, marks included."""
    if not any(line.article and line.weight for line in lines):
        return [line.weight for line in lines]
    return [line.weight * marked if line.article else line.weight // marked for line in lines]


def bodies_of(weights: list[int], window: int) -> list[Body]:
    bodies: list[Body] = []
    first, peak = None, 0
    for i in range(len(weights) + 1):
        here = sum(weights[i : i + window])
        if first is None and here > 0 and i < len(weights) and weights[i] > 0:
            first, peak = i, 0
        if first is not None:
            peak = max(peak, here)
            if here == 0:  # a dive: nothing in this window
                bodies.append(Body(first, max(k for k in range(first, i) if weights[k] > 0), peak))
                first = None
    return bodies


def main_lines(lines: list[Line], window: int = WINDOW, surge: int = SURGE, marked: int = MARKED) -> list[str]:
    """The lines between surge and dive points, and what belongs to them; if no window surges, of its highest rise."""
    weights = weights_of(lines, marked)
    bodies = bodies_of(weights, window)
    surging = [b.peak >= surge for b in bodies]
    if not any(surging) and bodies:
        surging[max(range(len(bodies)), key=lambda i: (bodies[i].peak, -i))] = True

    def held(body: Body) -> list[Line]:
        return [line for line, weight in zip(lines[body.first : body.last + 1], weights[body.first :]) if weight]

    high = [line for b, good in zip(bodies, surging) if good for line in held(b)]
    containers, articles = {line.container for line in high}, {line.article for line in high} - {0}
    kept: list[Body] = []
    follows = False
    for body, good in zip(reversed(bodies), reversed(surging)):
        own = held(body)
        good = good or any(line.container in containers or line.article in articles for line in own)
        good = good or follows and all(line.headline for line in own)
        follows = good
        if good:
            kept.append(body)
    return [
        line.text for b in reversed(kept) for line in lines[b.first : b.last + 1] if line.text and not line.aside
    ]


def main_text(page: str | None) -> str:
    return "\n".join(main_lines(lines_of(page))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    ``text`` is the main text: character references decoded, white space within
    a block one space, blocks in page order joined by a line feed. A null or
    empty page, or one without text outside its menus and the like, has the empty
    text. Nothing is cut however long a page is; repeated rows are extracted
    each; an empty table gives no rows; other columns are neither read nor
    returned. ``n_chars`` counts code points.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "html", HELD):
            texts = [main_text(page) for page in part.column("html").to_pylist()]
            columns = [part.column("page_id"), part.column("url")]
            columns += [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", "html")
    id_type = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars bigint")
