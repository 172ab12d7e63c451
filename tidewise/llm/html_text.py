"""Main text of web pages by composite text density.

Every page is parsed into a tree; what is not shown (scripts, styles, hidden
elements, form controls, embedded objects) is left out. For each node: C
characters, T tags, LC characters and LT tags in links, all of its subtree. Its
composite density is characters per tag, adjusted for links:

    C/T * log_b((C/LC) * (T/LT)),  b = ln(C/(C-LC) * LC + LCbody/Cbody * C + e)

A node's density sum is the sum of its children's densities (a run of text is
a child, too). The node of the largest sum is the centre of the article; the
smallest density on the path from body to it is the threshold. The article is
the centre's subtree, an article element that holds it, and headings right
before it; further, subtrees beside the path that reach the threshold and
PART_SHARE of the centre's sum (an article in several parts). No name of an
element takes part in this choice.

Only inside what is chosen, parts that are no article text by their tag, role or
class (reader comments, adverts, notices, forms, menus ...) and lists of links
are taken out: never an element with an article inside, nor, by class or as a
form, one with half of the text of the article or page that it belongs to.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one space in page order; br and every
block element end a block. Markup errors (unclosed or stray tags, cut pages)
follow the usual recovery of browsers for the elements involved.

Edge cases: null or empty html gives an empty text, as does a page without
text; text outside any tag belongs to body; other columns are not read; rows
are independent of each other, so repeated rows give equal texts; an empty
table gives an empty result. A page is one row's work whatever its length;
trees are built without recursion.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset "
                             "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre "
                             "section summary table ul".split())
SAME_LEVEL = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
              "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"),
              "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
LIST_SCOPE = frozenset("ul ol dl table article section div body main select".split())
PARAGRAPH_SCOPE = LIST_SCOPE - {"div"}

# What is no article text, by tag, role and the words of class and id.
NO_TEXT_TAGS = frozenset("script style noscript template head title textarea select option button iframe object svg "
                         "canvas nav footer aside form menu dialog datalist map audio video noembed noframes xmp".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar "
                          "toolbar form".split())
NO_TEXT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adsbygoogle adbox adslot adunit sponsor "
    "sponsored promo promos promotion nav navbar navigation navmenu mainnav subnav topnav menu menus menubar breadcrumb "
    "breadcrumbs pagination pager sidebar sidebars sidenav rightbar leftbar widget widgets related recommended trending "
    "footer copyright masthead topbar banner banners cookie cookies cookiebar consent gdpr notice notices notification "
    "notifications alert alerts popup popover modal overlay toast newsletter subscribe subscription signup login paywall "
    "share sharing social search".split())
COMMENT_WORDS = frozenset("comment comments commentlist respond reply replies disqus".split())
LAYOUT_WORDS = frozenset("no not non has have with without".split())  # what follows names another element
SOFT_TAGS = frozenset("nav footer aside form menu dialog".split())  # shown, and may hold the article
UNSEEN_TAGS = NO_TEXT_TAGS - SOFT_TAGS
HEADINGS = frozenset("h1 h2 h3".split())
PART_SHARE = 0.25
HEADER_WORDS = frozenset("header site top global".split())  # an element so named, header among them

_TAG_REST = re.compile(r"""[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _names(named: str) -> frozenset[str]:
    """Words of class and id that name the element itself."""
    found = set()
    for name in named.split():
        for word in _WORDS.findall(name):
            if word.lower() in LAYOUT_WORDS:
                break
            found.add(word.lower())
    return frozenset(found)


class Page:
    """Tree of a page in lists: nodes in document order, parents first."""

    def __init__(self, source: str):
        self.tag, self.parent, self.out, self.words, self.link = ["body"], [-1], [False], [frozenset()], [False]
        self.soft, self.form = [False], [False]  # out by tag or role, unless the article is inside; forms among them
        self.runs: list[tuple[int, int, str]] = []  # (node, block, text)
        self.block = 0
        self.stack = [0]
        self.opened: Counter[str] = Counter()   # open elements by tag
        self._parse(source)

    # -- parsing
    def _text(self, text: str) -> None:
        if text:
            self.runs.append((self.stack[-1], self.block, entities.unescape(text) if "&" in text else text))

    def _close(self, depth: int) -> None:
        for node in self.stack[depth:]:
            self.opened[self.tag[node]] -= 1
            if self.tag[node] not in INLINE:
                self.block += 1
        del self.stack[depth:]

    def _open_at(self, names, scope=frozenset()) -> int:
        """Depth of the innermost open element among ``names``; 0: none in scope."""
        if not any(self.opened[name] for name in names):
            return 0
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[depth]]
            if tag in names:
                return depth
            if tag in scope:
                return 0
        return 0

    def _start(self, name: str, rest: str) -> None:
        if name in ("html", "body"):
            return
        if name == "br" or name == "hr":
            self.block += 1
        if name in CLOSES_PARAGRAPH and (depth := self._open_at(("p",), PARAGRAPH_SCOPE)):
            self._close(depth)
        if name in SAME_LEVEL and (depth := self._open_at(SAME_LEVEL[name], LIST_SCOPE)):
            self._close(depth)
        if name == "a" and (depth := self._open_at(("a",), CLOSES_PARAGRAPH)):
            self._close(depth)
        if name in VOID:
            return
        attrs = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)} if rest.strip("/ \n\t") else {}
        roles = attrs.get("role", "").lower().split()
        out = (name in UNSEEN_TAGS or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true"
               or "display:none" in attrs.get("style", "").lower().replace(" ", ""))
        soft = (name in SOFT_TAGS or not NO_TEXT_ROLES.isdisjoint(roles)
                or name == "header" and not (self.opened["article"] or self.opened["main"]))
        named = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        self.tag.append(name)
        self.parent.append(self.stack[-1])
        self.out.append(out)
        self.soft.append(soft)
        self.form.append(soft and (name == "form" or "form" in roles))
        self.words.append(_names(named) if named != " " else frozenset())
        self.link.append(name == "a" and "href" in attrs)
        if name not in INLINE:
            self.block += 1
        self.stack.append(len(self.tag) - 1)
        self.opened[name] += 1

    def _end(self, name: str) -> None:
        if name == "p" and not self._open_at(("p",)):
            self.block += 1
            return
        if not self.opened[name]:
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[depth]]
            if tag == name:
                self._close(depth)
                return
            if name in INLINE and tag not in INLINE:
                return  # a stray inline end tag closes no block
            if name not in ("article", "main", "section", "div") and tag in ("article", "main"):
                return

    def _parse(self, s: str) -> None:
        at, n = 0, len(s)
        while at < n:
            i = s.find("<", at)
            if i < 0:
                self._text(s[at:])
                break
            c = s[i + 1:i + 2]
            if c.isascii() and c.isalpha():
                self._text(s[at:i])
                name = _NAME.match(s, i + 1)
                end = _TAG_REST.match(s, name.end())
                stop = end.end() if end else s.find(">", name.end()) + 1
                if not stop:
                    break  # the page ends inside a tag
                tag, rest = name[0].lower(), s[name.end():stop - 1]
                self._start(tag, rest)
                at = stop
                if tag in RAW and not rest.endswith("/"):
                    close = re.compile(f"</{tag}(?=[\\s/>]|$)", re.I).search(s, at)
                    at = close.start() if close else n
            elif c == "/" and s[i + 2:i + 3].isascii() and s[i + 2:i + 3].isalpha():
                self._text(s[at:i])
                name = _NAME.match(s, i + 2)
                stop = s.find(">", name.end())
                self._end(name[0].lower())
                at = n if stop < 0 else stop + 1
            elif s.startswith("<!--", i):
                self._text(s[at:i])
                stop = s.find("-->", i + 2)
                at = n if stop < 0 else stop + 3
            elif c and c in "!?/":
                self._text(s[at:i])
                stop = s.find(">", i)
                at = n if stop < 0 else stop + 1
            else:  # an ordinary < in the text
                stop = s.find("<", i + 1)
                stop = n if stop < 0 else stop
                self._text(s[at:stop])
                at = stop

    # -- density
    def _hide(self) -> None:
        for i in range(1, len(self.tag)):
            self.out[i] = self.out[i] or self.out[self.parent[i]]

    def choose(self) -> list[bool]:
        """Which nodes belong to the article, by density alone."""
        n = len(self.tag)
        chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        inside = list(self.link)
        for i in range(1, n):
            inside[i] = inside[i] or inside[self.parent[i]]
        runs = [(node, len(" ".join(text.split()))) for node, _, text in self.runs if not self.out[node]]
        for node, size in runs:
            chars[node] += size
            links[node] += size * inside[node]
        for i in range(n - 1, 0, -1):
            if not self.out[i]:
                p = self.parent[i]
                chars[p] += chars[i]
                links[p] += links[i]
                tags[p] += tags[i] + 1
                link_tags[p] += link_tags[i] + self.link[i]
        self.chars, self.links, self.link_tags = chars, links, link_tags
        if not chars[0]:
            return [False] * n
        share = links[0] / chars[0]

        def density(c: int, t: int, lc: int, lt: int) -> float:
            if not c:
                return 0.0
            t, lc, lt = max(t, 1), max(lc, 1), max(lt, 1)
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            return c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(max(base, 1.01))

        own = [0.0 if self.out[i] else density(chars[i], tags[i], links[i], link_tags[i]) for i in range(n)]
        sums = [0.0] * n
        for node, size in runs:
            sums[node] += density(size, 1, size * inside[node], inside[node])
        for i in range(n - 1, 0, -1):
            sums[self.parent[i]] += own[i]
        best = list(range(n))  # node of the largest sum in the subtree; the outer one of equals
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            if not self.out[i] and (sums[best[i]] > sums[best[p]] or sums[best[i]] == sums[best[p]] and best[p] != p):
                best[p] = best[i]
        centre, threshold, path = best[0], own[0], set()
        i = centre
        while i >= 0:
            threshold = min(threshold, own[i])
            path.add(i)
            i = self.parent[i]
        marked = [i for i in path if self.tag[i] == "article"]
        top = min(marked) if marked else centre     # the outermost article that holds the centre
        chosen = [False] * n
        for i in range(n):
            p = self.parent[i]
            beside = p in path and i not in path and i > 0 and not chosen[p]
            part = beside and own[i] >= threshold and sums[best[i]] >= PART_SHARE * sums[centre]
            title = beside and p == self.parent[top] and i < top and self.tag[i] in HEADINGS
            if part:
                chosen[best[i]] = True
            chosen[i] = not self.out[i] and (chosen[i] or i == top or title or p >= 0 and chosen[p])
        return chosen

    def _take_out(self, chosen: list[bool]) -> None:
        """Drop from what is chosen, in place: parts by tag and role, then by
        class and id, and lists of links. Not an element with an article inside,
        nor, by class or as a form, one with half of the text around it (that of
        its article, or of all that is chosen where no article is marked)."""
        n = len(self.tag)
        chars, holds, scope = [0] * n, [t in ("article", "main") for t in self.tag], [0] * n
        gone = [not c for c in chosen]
        for i in range(1, n):
            p = self.parent[i]
            scope[i] = p if self.tag[p] in ("article", "main") else scope[p]
        for i in range(n - 1, 0, -1):
            holds[self.parent[i]] = holds[self.parent[i]] or holds[i] and not self.out[i]
        for i in range(1, n):
            if chosen[i] and chosen[self.parent[i]]:
                gone[i] = gone[self.parent[i]]
            gone[i] = gone[i] or self.soft[i] and not self.form[i] and not holds[i]
        for node, _, text in self.runs:
            if not gone[node]:
                chars[node] += len(text.strip())
        for i in range(n - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
        for i in range(1, n):
            p, words = self.parent[i], self.words[i]
            if chosen[i] and chosen[p] and gone[p]:
                gone[i] = True
            elif chosen[i] and not holds[i] and not gone[i]:
                around = scope[i]
                small = holds[0] and not around or 2 * chars[i] < chars[around]
                gone[i] = small and (self.form[i] or bool(words & COMMENT_WORDS or words & NO_TEXT_WORDS)
                                     or "header" in words and words <= HEADER_WORDS)
            if (self.tag[i] in ("ul", "ol", "div", "section", "table") and self.link_tags[i] >= 3
                    and 10 * self.links[i] >= 7 * self.chars[i]):
                gone[i] = True
        for i in range(n):
            chosen[i] = chosen[i] and not gone[i]

    def text(self) -> str:
        self._hide()
        chosen = self.choose()
        self._take_out(chosen)
        blocks: dict[int, list[str]] = {}
        for node, block, text in self.runs:
            if chosen[node]:
                blocks.setdefault(block, []).append(text)
        flat = (" ".join("".join(parts).split()) for parts in blocks.values())
        return " ".join(b for b in flat if b)


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            texts = [main_text(h.as_py()) for h in part.column(2)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
