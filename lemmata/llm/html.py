"""Operator 2: main text of web pages by line-block distribution.

A page is stripped of markup into lines, one for each block of text. Lines of
menus, headers, footers, sidebars, notices, adverts, forms and reader comments
keep their place but weigh nothing, and each such part leaves a gap as wide as
the window. Sums of text length over sliding windows of lines surge over a threshold
where text begins, if the next window doesn't fall back, and dive under it where
text ends: these are the regions.
Where the page marks its article, that mark replaces the method: all lines in it that
are in no such part stay. Else the heaviest region and any other of at least a quarter
of its weight tell where the article is: all lines from the first of these regions to
the last stay, and all other lines in the container that holds most of their text,
however light. Siblings of one name and the same attributes are one container. Where
that container is the whole body, light lines without heading or sentence, such as the
words of a bare menu, are cut off both ends of what stays, and lines that are mostly
links stay only between the regions.

Names in class, id and role are hints. A part that only a hint sets apart, but for
comments, is none if it holds most of the page's text and an article, a main part or
a first heading. End tags that HTML lets out end a part too.

Defined results: null and empty pages have an empty text; a page without any
article text too; markup that is cut off ends with the page; line breaks within a
block are white space; repeated rows and ids each get a row, null ids are carried;
other columns are not; lines of equal weight are told apart by their place; pages of
any length are read whole; an empty table gives an empty table.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

WINDOW = 3
#: Characters that the lines of a window must have, or half of the page's heaviest window.
THRESHOLD = 80
#: Lines of fewer characters are light.
LIGHT = 30
#: Where markup begins that is no text of the page: comments, and elements without text of their own.
RAW = re.compile(
    r"<!--|<(script|style|noscript|template|svg|annotation|annotation-xml|canvas|textarea|iframe|object|title)\b[^>]*>|<!\[CDATA\[|\]\]>|<![^>]*>|<\?[^>]*>", re.I
)
TAG = re.compile(r"<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(/?)>|<(/?)([a-zA-Z][\w:-]*)[^>]*\Z")
BLOCK = frozenset(
    "address article aside blockquote body button caption center col colgroup dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li link main menu meta nav ol option p pre "
    "search section select summary table tbody td tfoot th thead tr ul video audio".split()
)
#: Elements whose end tag may be missing: what they end with, at the same depth.
IMPLIED = {
    "p": BLOCK, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
}
#: Elements that hold others of the same names at a depth of their own.
NESTING = frozenset("ul ol dl table menu".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never belong to an article.
APART = frozenset("nav footer aside form menu dialog select button fieldset search".split())
#: Elements that tell one part of a page from another.
CONTAINER = frozenset("div section center td".split())
#: Words in class, id or role that mark such parts.
MARK = re.compile(
    r"""(?:^|[\s"'_-])(?:ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|breadcrumb\w*|sidebar|side|"""
    r"""footer|foot|masthead|topbar|site-?header|page-?header|cookie\w*|consent|gdpr|notice|alert|popup|modal|newsletter|subscri\w*|"""
    r"""comment\w*|disqus|replies|reply|share|sharing|social|related|recommend\w*|pagination|pager|login|signup|search|"""
    r"""contentinfo|complementary|dialog|skip\w*|toolbar|widget\w*|legal|copyright|hidden|sr-only)(?=$|[\s"'_-])""",
    re.I,
)
#: Names that tell the state of a wrapper, not a part.
STATE = re.compile(r"^(?:has|with|without|no|is|js|layout)-", re.I)
COMMENTS = re.compile(r"comment|disqus|repl(?:y|ies)", re.I)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
CONCEALED = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none|visibility\s*:\s*hidden""", re.I)
SPACE = re.compile(r"\s+")


def without_raw(page: str) -> str:
    """The page without comments, scripts and the like. One that is never closed goes on to the end if it is a script, style or comment."""
    out, at = [], 0
    unclosed: set[str] = set()
    while m := RAW.search(page, at):
        out.append(page[at : m.start()])
        at = m.end()
        if m[0] == "<!--":
            end = page.find("-->", m.start() + 2)
            at = end + 3 if end >= 0 else len(page)
        elif m[1] and (name := m[1].lower()) not in unclosed and not m[0].endswith("/>"):
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            if end:
                at = end.end()
            elif name in ("script", "style"):
                at = len(page)
            else:
                unclosed.add(name)
            out.append(" ")
    out.append(page[at:])
    return "".join(out)


def set_apart(name: str, attributes: str, in_article: bool) -> str:
    """Why an element is no part of an article: its tag, a hint in its attributes, or a hint of comments; empty if it may be."""
    if name in APART or (name == "header" and not in_article):
        return "tag"
    if not attributes or name in ("html", "body", "article", "main"):
        return ""
    if CONCEALED.search(attributes):
        return "tag"
    for v in ATTRIBUTE.findall(attributes):
        words = [w for w in v.strip("\"'").split() if not STATE.match(w)]
        hits = [m[0] for w in words if (m := MARK.search(w))]
        if hits:
            return "comments" if any(COMMENTS.search(h) for h in hits) else "hint"
    return ""


@dataclass
class Lines:
    """Lines of a page, side by side."""

    texts: list[str] = field(default_factory=list)
    apart: list[bool] = field(default_factory=list)
    marked: list[bool] = field(default_factory=list)  # in a marked article
    links: list[int] = field(default_factory=list)  # characters of links
    held_by: list[int] = field(default_factory=list)  # container
    tags: list[str] = field(default_factory=list)  # of the block

    def put(self, *values) -> None:
        for to, v in zip((self.texts, self.apart, self.marked, self.links, self.held_by, self.tags), values):
            to.append(v)

    def cut(self, n: int) -> None:
        for x in (self.texts, self.apart, self.marked, self.links, self.held_by, self.tags):
            del x[n:]


def lines_of(page: str) -> tuple[Lines, list[int]]:
    """Lines of a page, and the containers' parents; container 0 is the body, its own parent, and parents come before what they hold."""
    page = without_raw(page)
    tags = list(TAG.finditer(page))
    ends = [0, *(m.end() for m in tags)]
    size_to = [0]  # characters of text before each tag
    for m, e in zip(tags, ends):
        size_to.append(size_to[-1] + len(page[e : m.start()].strip()))
    size_to.append(size_to[-1] + len(page[ends[-1] :].strip()))
    out, parents = Lines(), [0]
    known: dict[tuple[int, str, str], int] = {}
    inside: list[tuple[str, int]] = [("", 0)]  # open containers
    buffer: list[str] = []
    block = ""
    exempt: set[int] = set()  # tags of wrappers that hints took for parts
    skip, skip_name, why, nest = 0, "", "", 0  # depth of elements of the name that opened the part
    opened, lines_then, state_then, main_in = 0, 0, (0, 0, 0), False
    article = link = linked = seen = 0

    def close():
        nonlocal linked
        if buffer:
            t = SPACE.sub(" ", html.unescape("".join(buffer))).strip()
            buffer.clear()
            if t:
                out.put(t, bool(skip), article > 0, min(linked, len(t)), inside[-1][1], block)
        linked = 0

    def gap():
        for _ in range(WINDOW):
            out.put("", True, article > 0, 0, inside[-1][1], "")

    k = 0
    while k <= len(tags):
        if k == len(tags):  # the end of the page, where an open part ends too
            if page[ends[k] :]:
                buffer.append(page[ends[k] :])
            wrapper = skip and why == "hint" and main_in and 2 * (size_to[k + 1] - size_to[opened + 1]) > size_to[-1]
            if not wrapper:
                close()
                break
        else:
            m = tags[k]
            if m.start() > ends[k]:
                piece = page[ends[k] : m.start()]
                buffer.append(piece)
                if link:
                    linked += len(piece.strip())
            closing, name, attributes, selfclosing = m[1] or m[5], (m[2] or m[6]).lower(), m[3] or "", m[4]
            if name == "br":
                buffer.append(" ")
            wrapper = False
            if name in BLOCK:
                close()
                block = "" if closing else name
            if skip:
                over = False
                if name == skip_name and not selfclosing and not (not closing and not nest and name in IMPLIED):
                    skip += -1 if closing else 1
                    over = not skip
                elif not nest and skip_name in IMPLIED and ((not closing and name in IMPLIED[skip_name]) or (closing and name in BLOCK and name != skip_name)):
                    skip, over = 0, True
                elif closing and name in ("article", "main", "body") and skip_name not in ("article", "main"):
                    skip, over = 0, True  # the part was never closed
                elif name in NESTING:
                    nest = max(0, nest + (-1 if closing else 1))
                elif not closing and name in ("article", "main", "h1") and not seen and not set_apart(name, attributes, False):
                    main_in = True
                wrapper = over and why == "hint" and main_in and 2 * (size_to[k + 1] - size_to[opened + 1]) > size_to[-1]
                if over and not wrapper:
                    gap()
                if not wrapper and (not over or name == skip_name and closing):
                    k += 1
                    continue
        if wrapper:  # read it again, as no part
            out.cut(lines_then)
            buffer.clear()
            exempt.add(opened)
            skip, linked = 0, 0
            article, link, seen = state_then
            k = opened
            continue
        if closing:
            if name == "a":
                link = max(0, link - 1)
            elif name in ("article", "main"):
                article = max(0, article - 1)
            elif name in CONTAINER:
                j = next((j for j in range(len(inside) - 1, 0, -1) if inside[j][0] == name), len(inside))
                del inside[j:]
        elif name not in VOID and not selfclosing:
            why = "" if k in exempt else set_apart(name, attributes, article > 0)
            if why:
                close()
                opened, lines_then, state_then, main_in = k, len(out.texts), (article, link, seen), False
                skip, skip_name, nest = 1, name, 0
                gap()
            elif name == "a":
                link += 1
            elif name in ("article", "main"):
                article += 1
                seen += 1
            elif name in CONTAINER:
                key = (inside[-1][1], name, attributes.strip())
                if key not in known:
                    known[key] = len(parents)
                    parents.append(key[0])
                inside.append((name, known[key]))
        k += 1
    return out, parents


def regions(weights: np.ndarray, window: int = WINDOW, threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """Runs of lines between a surge of window sums over the threshold and their dive under it.

    A surge holds for two windows, unless the lines end. Of the windows of a run all
    lines with weight are its own, and those next to them up to the next window that is empty.
    """
    n = len(weights)
    if not n or not weights.any():
        return []
    sums = np.convolve(weights, np.ones(window, weights.dtype))[window - 1 :][:n]  # of lines i to i + window - 1
    level = max(1, min(threshold, int(sums.max()) // 2))
    full = sums >= level
    held = full & (np.append(full[1:], True) | np.insert(full[:-1], 0, False))  # one window alone is no surge
    held = held if held.any() else full
    edge = np.concatenate([[0], held.astype(np.int8), [0]])
    surge, dive = np.nonzero(np.diff(edge) == 1)[0], np.nonzero(np.diff(edge) == -1)[0]
    out = []
    for a, b in zip(surge.tolist(), dive.tolist()):
        own = np.nonzero(weights[a : b + window - 1])[0]
        a, b = a + int(own[0]), a + int(own[-1]) + 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


SENTENCE = re.compile(r"[.!?…:;。！？][\"'»”’)\]]*$")


def chosen(own: np.ndarray, lines: Lines, parents: list[int]) -> list[int]:
    """Lines that stay on a page without a marked article."""
    linked = 2 * np.array(lines.links) > own
    plain = np.where(linked, 0, own)
    found = regions(plain)
    if not found:
        return []
    heavy = [int(plain[a:b].sum()) for a, b in found]
    heavy_regions = [r for r, w in zip(found, heavy) if 4 * w >= max(heavy)]
    first, last = heavy_regions[0][0], heavy_regions[-1][1]
    weight = [0] * len(parents)
    for a, b in heavy_regions:
        for i in range(a, b):
            weight[lines.held_by[i]] += int(plain[i])
    for k in range(len(parents) - 1, 0, -1):
        weight[parents[k]] += weight[k]
    # those with more than half of the text are each in the other, the innermost last
    best = max(k for k, w in enumerate(weight) if 2 * w > weight[0])
    within = [best == 0]
    for k in range(1, len(parents)):
        within.append(k == best or within[parents[k]])
    kept = [i for i in np.nonzero(own)[0].tolist() if first <= i < last or (within[lines.held_by[i]] and (best or not linked[i]))]
    if not best:  # nothing holds the article together: a bare menu may stand at either end
        bare = lambda i: own[i] < LIGHT and lines.tags[i] not in HEADING | {"p"} and not SENTENCE.search(lines.texts[i])
        while kept and bare(kept[0]):
            kept.pop(0)
        while kept and bare(kept[-1]):
            kept.pop()
    return kept


def main_text(page: str) -> str:
    if not page:
        return ""
    lines, parents = lines_of(page)
    own = np.array([0 if a else len(t) for t, a in zip(lines.texts, lines.apart)], np.int64)
    if not own.any():
        return ""
    if any(m and w for m, w in zip(lines.marked, own.tolist())):
        kept = [i for i, m in enumerate(lines.marked) if m and own[i]]
    else:
        kept = chosen(own, lines, parents)
    return "\n".join(lines.texts[i] for i in kept)


def extract_main_text(pages: DataFrame, id_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """Per page: the id columns, text and n_chars (code points)."""

    def run(raw):
        made = [main_text(p) for p in raw]
        return {"text": pa.array(made, pa.string()), "n_chars": pa.array([len(t) for t in made], pa.int64())}

    return map_texts(pages, run, "text string, n_chars bigint", id_cols, html_col).select(*(F.col(f"`{c}`") for c in id_cols), "text", "n_chars")
