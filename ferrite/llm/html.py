"""Main text of web pages by composite text density.

Every block element of the DOM gets its characters per tag, adjusted by how
much of its text and tags are links.  The element with the largest sum of its
children's densities holds the main text; the least density on its path to the
body is the threshold for other dense parts.  An article or main element on
that path widens the choice to the outermost such element.  Elements that are not the
article by their tag (menus, footers and so on) are left out before densities
are taken, and so are those whose class, id or role says so (adverts, notices,
comments and so on), whatever their size; a name that may be a wrapper's
("layout has-sidebar") is left out unless it holds the text: see ``_marked_out``.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrite.llm.common import append_columns, table

# Element names by their role in HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
summary table tbody td tfoot th thead tr ul""".split())
_LEFT_OUT = frozenset("""head script style noscript template iframe object svg math canvas audio video nav footer aside button
select textarea input datalist dialog menu map title""".split())
_CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
              "option": ("option",)}
_HOLDS = frozenset("ul ol menu dl table select".split())
_ENDS_P = _BLOCK - {"html", "body", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "legend", "summary"}
# Words of class, id and role values that mark what is not the article.
_NOT_MAIN = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner
cookie cookies consent gdpr notice notices notification alert popup modal overlay toast paywall newsletter subscribe subscription
signup login sidebar sidebars rail aside complementary menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager
footer footers contentinfo comment comments commentlist disqus replies respond share sharing social related recommended
recommendations teaser teasers widget widgets search form toolbar skip""".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Beside such a word these say nothing: "comment-list" is as plain as "comments".
_NEUTRAL = frozenset("""list lists item items box block area section wrap wrapper container inner outer body bar panel group thread
entry post posts articles stories story page site global primary secondary main left right top bottom first second
count link links button meta text title form sign up""".split())
#: What a name tells of an element: nothing, perhaps that it is not the article, surely so.
_PLAIN, _MAYBE, _SURE = 0, 1, 2


def _left_out(tag: str, attrs: list, in_article: bool) -> bool:
    """Not the article, whatever its text."""
    if tag in _LEFT_OUT or (tag == "header" and not in_article):
        return True
    return tag not in ("html", "body", "article", "main") and any(
        name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and value and _HIDDEN.search(value))
        for name, value in attrs)


def _mark(tag: str, attrs: list, in_article: bool) -> int:
    """What class, id, role and tag say of an element.

    A name is sure if all its words say so ("cookie-banner", "comment-list"),
    and a form in an article; a name with other words besides ("layout
    has-sidebar", "no-comments") and any other form may be a wrapper of the
    whole page.  An article or main is marked by a sure name alone.
    """
    if tag in ("html", "body"):
        return _PLAIN
    mark = _PLAIN if tag != "form" else _SURE if in_article else _MAYBE
    for name, value in attrs:
        if name not in ("class", "id", "role") or not value:
            continue
        for token in value.split():
            words = {w.lower() for w in _WORDS.findall(token)}
            if name == "id" and (tag in _HEADINGS or (tag == "section" and words - _NOT_MAIN)):
                continue  # named after its own title
            bad = words & _NOT_MAIN
            if not in_article:
                bad |= words & {"header", "masthead"}
            if tag == "form":
                bad -= {"form"}
            if bad:
                sure = not words - bad - _NEUTRAL
                mark = max(mark, _SURE if sure else _PLAIN if tag in ("article", "main") else _MAYBE)
    return mark


class _Dom(HTMLParser):
    """Block elements in page order, with what stands in each."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.out = ["html"], [0], [False]
        self.marked, self.inside = [_PLAIN], [False]  # what its name says; in an article
        self.own = [[0, 0, 0, 0]]  # characters, link characters, tags, link tags
        self.said: list[tuple[int, str]] = []  # (block, text); a blank stands where blocks meet
        self.stack: list[tuple[str, int, bool, bool]] = []  # (tag, block, in a link, in an article)
        self.open: dict[str, int] = {}
        self.links = self.chars = 0

    def _top(self) -> tuple[str, int, bool, bool]:
        return self.stack[-1] if self.stack else ("", 0, False, False)

    def _pop_to(self, at: int) -> None:
        for tag, *_ in self.stack[at:]:
            self.open[tag] -= 1
        del self.stack[at:]
        self.said.append((self._top()[1], " "))

    def _close(self, tags: tuple, stop: frozenset) -> None:
        """Close the innermost open element of ``tags`` unless one of ``stop`` is inside it."""
        if not any(self.open.get(t) for t in tags):
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] in tags:
                return self._pop_to(at)
            if self.stack[at][0] in stop:
                return None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _ENDS_P:
            self._close(("p",), _BLOCK - {"p"})
        if tag in _CLOSED_BY:
            self._close(_CLOSED_BY[tag], _HOLDS)
        _, block, link, article = self._top()
        link = link or tag == "a"
        article = article or tag in ("article", "main")
        out = self.out[block]
        marked = _PLAIN if out else _mark(tag, attrs, article)
        if tag in _BLOCK or tag in _LEFT_OUT or marked or (not out and attrs and _left_out(tag, attrs, article)):
            self.tags.append(tag)
            self.parents.append(block)
            self.out.append(out or _left_out(tag, attrs, article))
            self.marked.append(marked)
            self.inside.append(article)
            self.own.append([0, 0, 0, 0])
            block = len(self.tags) - 1
            self.said.append((block, " "))
        elif tag == "br":
            self.said.append((block, " "))
        own = self.own[block]
        own[2] += 1
        own[3] += tag == "a"
        if tag not in _VOID:
            self.stack.append((tag, block, link, article))
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # in HTML the slash means nothing

    def handle_endtag(self, tag: str) -> None:
        if self.open.get(tag):
            for at in range(len(self.stack) - 1, -1, -1):
                if self.stack[at][0] == tag:
                    if tag in _BLOCK or tag in _LEFT_OUT or self.stack[at][1] != (self.stack[at - 1][1] if at else 0):
                        return self._pop_to(at)
                    # an inline end tag does not close the blocks opened since
                    if all(t not in _BLOCK for t, *_ in self.stack[at:]):
                        for t, *_ in self.stack[at:]:
                            self.open[t] -= 1
                        del self.stack[at:]
                    return None
        elif tag in _BLOCK or tag == "br":
            self.said.append((self._top()[1], " "))

    def handle_data(self, data: str) -> None:
        tag, block, link, _ = self._top()
        if tag in ("script", "style"):
            return
        self.said.append((block, data))
        n = sum(map(len, data.split()))
        own = self.own[block]
        own[0] += n
        self.chars += n
        if link:
            own[1] += n
            self.links += n


def _density(c: int, lc: int, t: int, lt: int, share: float) -> float:
    """Characters per tag, adjusted for links; ``share``: of the body's characters those in links."""
    if not c:
        return 0.0
    base = math.log(math.log(c / max(1, c - lc) * lc + share * c + math.e))
    t = max(1, t)
    value = math.log(max(1.0, c / max(1, lc) * t / max(1, lt)))
    return c / t * (value / base if base > 1e-9 else value)


def _densities(dom: _Dom, out: list[bool]) -> tuple[list, list[float], list[float]]:
    """Totals, density and sum of the children's densities of each element that is not left out."""
    n, parents = len(dom.tags), dom.parents
    totals = [list(x) if not o else [0, 0, 0, 0] for x, o in zip(dom.own, out)]
    for i in range(n - 1, 0, -1):
        if not out[i]:
            up = totals[parents[i]]
            for k in range(4):
                up[k] += totals[i][k]
    share = dom.links / max(1, dom.chars)
    density = [0.0 if o else _density(*x, share) for x, o in zip(totals, out)]
    sums = [0.0] * n
    for i in range(1, n):
        if not out[i]:
            sums[parents[i]] += density[i]
    return totals, density, sums


def _marked_out(dom: _Dom) -> list[bool]:
    """Which elements are left out: by tag, or by what their names say, whatever their size.

    A surely marked element goes, unless all articles and mains of the page
    are in such elements and it holds one.  An element that is perhaps marked
    goes unless it holds an article or main, or is on the way to the largest
    sum of densities (inside an article, or in a page without one).  If no
    text would remain, names count for nothing.
    """
    n, parents, out = len(dom.tags), dom.parents, list(dom.out)
    if not any(m and not o for m, o in zip(dom.marked, out)):
        return out
    totals, _, _ = _densities(dom, out)
    named = [not out[i] and dom.tags[i] in ("article", "main") and dom.marked[i] == _PLAIN and totals[i][0] > 0 for i in range(n)]
    holds, under = list(named), [m == _SURE for m in dom.marked]
    for i in range(n - 1, 0, -1):
        holds[parents[i]] |= holds[i]
    for i in range(1, n):
        under[i] |= under[parents[i]]
    outside = any(a and not u for a, u in zip(named, under))
    for i in range(1, n):
        out[i] |= out[parents[i]] or (dom.marked[i] == _SURE and (outside or not holds[i]))
    totals, _, sums = _densities(dom, out)
    if not totals[0][0]:
        return list(dom.out)
    outside = any(a and not o for a, o in zip(named, out))
    way, at = set(), max(range(n), key=lambda i: sums[i])
    while at:
        way.add(at)
        at = parents[at]
    by_sure = list(out)
    for i in range(1, n):
        keeps = holds[i] or (i in way and (dom.inside[i] or not outside))
        out[i] |= out[parents[i]] or (dom.marked[i] == _MAYBE and not keeps)
    return out if _densities(dom, out)[0][0][0] else by_sure


def main_text(page: str) -> str:
    """The article of an HTML page, white space in blocks and between them one blank."""
    dom = _Dom()
    dom.feed(page)
    dom.close()
    n, parents, tags, out = len(dom.tags), dom.parents, dom.tags, _marked_out(dom)
    _, density, sums = _densities(dom, out)
    best = max(range(n), key=lambda i: sums[i])
    if not sums[best]:
        best = 0
    path = [best]
    while path[-1]:
        path.append(parents[path[-1]])
    chosen = [False] * n
    chosen[best] = True
    if holders := [i for i in path if tags[i] in ("article", "main")]:
        chosen[holders[-1]] = True  # the page's own word for the whole of it
    # other parts that are as dense as the thinnest part of the way to the body
    least = min((density[i] for i in path if tags[i] not in ("html",)), default=density[best])
    top = list(range(n))  # of each subtree, the element with the largest sum
    for i in range(n - 1, 0, -1):
        if not out[i] and sums[top[i]] > sums[top[parents[i]]]:
            top[parents[i]] = top[i]
    way = set(path)
    for i in range(1, n):
        if not out[i] and i not in way and density[i] >= least and density[i] > 0:
            chosen[top[i] if sums[top[i]] else i] = True
    for i in range(1, n):
        chosen[i] = not out[i] and (chosen[i] or chosen[parents[i]])
    text = "".join([s if chosen[i] else " " for i, s in dom.said])
    return " ".join(text.split())


def extracted(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` (the main text of ``html``; empty if none) and ``n_chars``.

    A null or empty html gives an empty text.  Repeated rows give repeated
    results; very long pages are read whole, one at a time.  Columns of ``pages`` named text or n_chars are replaced.
    """
    def start():
        def f(pages):
            texts = [main_text(p) if p else "" for p in pages.to_pylist()]
            return [texts, [len(t) for t in texts]]
        return f

    return append_columns(pages, ["html"], [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())], start)


def op9_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", F.col("n_chars"))
