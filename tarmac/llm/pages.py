"""Main text of raw HTML pages: flat text blocks and a decision tree.

A page is cut into flat blocks at its block-level tags (and at two line breaks in a
row). A block knows its words, its share of linked words (link density), and those of
the block before and after it. The tree's other features come from the markup around
it, for adverts, notices and reader comments can look exactly
like paragraphs: whether an element around it is an article or main element, or is named
like one; whether one is a menu, page header, footer, sidebar, form, hidden, or named
like an advert, a notice or comments; whether the block is a heading; whether the page
has an article and the block is outside it; and the last one is whether it ends like a
sentence.

``TABLE`` holds the small labelled table. ``grow`` fits a classification tree (Gini
impurity, midpoints between neighbouring values, until leaves are pure or would hold one
row) on the driver;
its size is fixed by the table, and the pages are classified by it inside their tasks.
Texts never leave the task that read them: there is no shuffle.

The result keeps, in page order, every block that the tree calls main text: character
references decoded, white space inside a block (non-breaking space included) turned into
one space, trimmed, blocks joined by one line feed. Nothing else is dropped or cut.

Edge cases: null or empty html, or html without text, gives an empty text; unclosed
tags, comments, scripts and quotes are read to the end of the page as browsers do; a
``<`` that starts no tag is text; very long pages are read whole, in linear time;
repeated rows and equal ids give a row each; null ids and urls stay null; an empty table
gives an empty result; other columns are ignored, whatever their names."""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: bytes of text in a batch that a task returns
OUT_BYTES = 8 << 20

# ---- blocks ---------------------------------------------------------------------------------

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q rp rt ruby s samp
small span strike strong sub sup time tt u var nobr picture map""".split()) | (VOID - {"hr"})
#: their text is no part of the page
RAW = frozenset("script style title textarea template noscript iframe noembed noframes xmp object svg math audio video canvas".split())
#: unclosed, these swallow the rest of the page
GREEDY = frozenset("script style title textarea iframe xmp".split())
#: an opening tag closes an open element of these names, up to the named container
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
JUNK_TAGS = frozenset("nav footer aside form dialog menu button select fieldset".split())
JUNK_ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar
tablist status""".split())
JUNK_NAMES = frozenset("""ad ads adv alert anzeige werbung publicidad publicite banner nav menu menus footer masthead topbar toolbar
aside rail widget widgets consent gdpr notice notices disclaimer popup modal overlay toast signup login paywall share sharing social
disqus respond reply replies related trending popular teaser teasers copyright skip form""".split())
#: beginnings of words that say the same
JUNK_STEMS = re.compile(r"(?:advert|adsense|ad(?:slot|box|unit|container|wrapper|banner|block|space|zone)|sponsor|promo|navig|navbar|navmenu"
                        r"|breadcrumb|paginat|pager|footer|sidebar|cookie|newsletter|subscri|comment(?!ary)|kommentar|commentaire|comentario"
                        r"|recommend)")
#: whole names of what is not shown
UNSEEN = frozenset("hidden is-hidden visually-hidden sr-only screen-reader-text".split())
MAIN_NAMES = frozenset("article post entry story content contents main prose".split())
#: a name with one of these words says something about the page's layout, not about the element
LAYOUT = frozenset("has with no without layout".split())
COMMENT_HEADINGS = frozenset("""comments comment reader comments|readers comments|user comments|leave a comment|leave a reply|add a comment
|post a comment|kommentare|leserkommentare|commentaires|comentarios""".replace("\n", "").replace("comments comment reader", "comments|comment|reader").split("|"))

TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|</(?![A-Za-z])[^>]*>"""
                   r"""|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*+)>""", re.S)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
CLOSE = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
SENTENCE = tuple(".!?…:;。！？") + tuple(a + b for a in ".!?…" for b in "\"'”’»)")


@lru_cache(4096)
def _name_says(name: str) -> tuple[bool, bool, bool]:
    """(junk, main, header) of one class name or id."""
    words = {w.lower() for w in PART.findall(name)}
    if words & LAYOUT:
        return False, False, False
    junk = bool(words & JUNK_NAMES) or any(JUNK_STEMS.match(w) for w in words) or name.lower() in UNSEEN
    main = not junk and bool(words & MAIN_NAMES)
    return junk, main, not main and "header" in words


def _says(tag: str, attrs: str) -> tuple[bool, int, bool]:
    """(junk, main level, page header) of an opening tag."""
    junk, main, header = tag in JUNK_TAGS, 2 * (tag in ("article", "main")), tag == "header"
    if attrs and not attrs.isspace() and tag not in ("html", "body"):
        for key, value in ATTR.findall(attrs):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id"):
                for name in value.split():
                    j, m, h = _name_says(name)
                    junk, main, header = junk or j, max(main, int(m)), header or h
            elif key == "aria-label":
                junk = junk or _name_says(value)[0]
            elif key == "itemprop":
                main = 2 if value.lower() == "articlebody" else main
            elif key == "role":
                junk, main = junk or value.lower() in JUNK_ROLES, 2 if value.lower() in ("main", "article") else main
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and HIDING.search(value)):
                junk = True
    return junk, main, header


class _Open:
    """An open element: what it and the elements around it say."""
    __slots__ = ("name", "junk", "main", "heading", "form")

    def __init__(self, name, junk, main, heading, form):
        self.name, self.junk, self.main, self.heading, self.form = name, junk, main, heading, form


class Blocks:
    """The flat blocks of one page: texts and rows (words, linked, main, junk, heading)."""

    def __init__(self, html: str):
        self.texts: list[str] = []
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.open = [_Open("", False, 0, 0, False)]
        self.count: dict[str, int] = {}
        self.part: list[str] = []
        self.linked, self.link, self.breaks = 0, 0, 0
        self._read(html)

    def _read(self, html: str) -> None:
        at, end, unclosed = 0, html.rfind(">") + 1, set()
        while True:
            m = TOKEN.search(html, at, end)
            if m is None:
                break
            self._text(html[at:m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
                continue
            self._start(tag, m[3])
            if tag in RAW and not m[3].endswith("/") and tag not in unclosed:
                close = CLOSE[tag].search(html, at)
                if close is not None:
                    at = close.end()
                elif tag in GREEDY:
                    at = end = len(html)
                else:
                    unclosed.add(tag)
        rest = html[at:]
        cut = re.search(r"<[A-Za-z/!?]", rest)  # a tag that never ends
        self._text(rest[:cut.start()] if cut else rest)
        self._flush()

    def _text(self, raw: str) -> None:
        if not raw:
            return
        s = unescape(raw) if "&" in raw else raw
        if s.isspace():
            self.part.append(" ")
            return
        self.breaks = 0
        self.part.append(s)
        if self.link:
            self.linked += len(s.split())

    def _flush(self) -> None:
        words = "".join(self.part).split()
        if words:
            here = self.open[-1]
            text = " ".join(words)
            if here.heading and len(words) < 6 and re.sub(r"[^a-z ]", "", text.lower()).strip() in COMMENT_HEADINGS:
                here.junk = self.open[-2].junk = True  # what follows beside such a heading are comments
            self.texts.append(text)
            self.rows.append((len(words), min(self.linked, len(words)), here.main, int(here.junk), here.heading))
        self.part, self.linked, self.breaks = [], 0, 0

    def _start(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self.part.append(" ")
            self.breaks += 1
            if self.breaks > 1:
                self._flush()
            return
        if tag == "a":
            self.link = len(self.open) if "href" in attrs.lower() else 0
        junk, main, header = _says(tag, attrs)
        inline = tag in INLINE
        if tag in VOID or tag in RAW or (inline and not junk):
            if not inline and tag not in RAW:
                self._flush()
            return
        self._flush()
        if not inline:
            if self.open[-1].name == "p":
                self._pop()
            names, until = CLOSES.get(tag, ((), ()))
            if any(self.count.get(n) for n in names):
                for i in range(len(self.open) - 1, 0, -1):
                    if self.open[i].name in until:
                        break
                    if self.open[i].name in names:
                        while len(self.open) > i:
                            self._pop()
                        break
        up = self.open[-1]
        heading = {"h1": 2, "h2": 1, "h3": 1, "h4": 1, "h5": 1, "h6": 1}.get(tag, up.heading)
        if junk or (header and not up.main):
            here = _Open(tag, True, 0, heading, tag == "form" and not up.junk)
        elif up.junk and not (tag == "main" or (main == 2 and up.form)):
            here = _Open(tag, True, 0, heading, up.form)
        else:
            here = _Open(tag, False, max(main, up.main), heading, False)
        self.open.append(here)
        self.count[tag] = self.count.get(tag, 0) + 1

    def _pop(self) -> None:
        gone = self.open.pop()
        self.count[gone.name] -= 1
        if self.link > len(self.open):
            self.link = 0

    def _end(self, tag: str) -> None:
        if tag == "a":
            self.link = 0
        if tag in VOID or (tag in INLINE and not self.count.get(tag)):
            return
        self._flush()
        if self.count.get(tag):
            while self.open[-1].name != tag:
                self._pop()
            self._pop()


# ---- features and the tree ------------------------------------------------------------------

FEATURES = ["junk", "outside", "main", "heading", "sentence", "words", "links", "words_before", "words_after",
            "links_before", "links_after"]
#: labelled blocks that a leaf must hold
LEAF = 2
#: words, or share of the words that are not junk, that a page's article must have to make the rest the outside
ARTICLE_WORDS, ARTICLE_SHARE = 25, 0.2


def features(rows: list[tuple], sentence: list[bool]) -> np.ndarray:
    """One row per block of a page from its (words, linked, main, junk, heading)."""
    a = np.array(rows, np.float64).reshape(-1, 5)
    words, main = a[:, 0], a[:, 2]
    links = a[:, 1] / np.maximum(words, 1)
    before, after = (lambda v: np.append(0, v[:-1])), (lambda v: np.append(v[1:], 0))
    level, free = 0, words[a[:, 3] == 0].sum()
    for k in (2, 1):
        inside = words[main == k].sum()
        if inside >= ARTICLE_WORDS or inside > ARTICLE_SHARE * free:
            level = k
            break
    return np.stack([a[:, 3], (main < level).astype(np.float64), main, a[:, 4], np.array(sentence, np.float64), words, links,
                     before(words), after(words), before(links), after(links)], 1)


# The labelled table: pages apart by an empty line, one block a row:
# kept, words, linked words, main level, junk, heading level, ends like a sentence
TABLE = """
0 1 1 0 1 0 0
0 2 2 0 1 0 0
0 9 0 0 1 0 1
1 7 0 2 0 2 0
1 1 0 2 0 0 1
1 62 1 2 0 0 1
1 3 0 2 0 0 0
1 24 0 2 0 0 1
0 14 0 0 1 0 1
1 85 4 2 0 0 1
1 1 0 2 0 0 0
0 40 0 0 1 0 1
0 8 0 0 1 0 0

0 1 1 0 0 0 0
0 1 1 0 0 0 0
0 2 2 0 0 0 0
1 6 0 0 0 2 0
1 48 0 0 0 0 1
1 30 2 0 0 0 1
1 4 0 0 0 0 1
1 55 0 0 0 0 1
1 3 0 0 0 1 0
1 71 3 0 0 0 1
0 5 0 0 0 0 0
0 2 2 0 0 0 0
0 3 3 0 0 0 0

0 2 2 0 0 0 0
0 26 0 0 0 0 1
0 4 0 0 0 1 0
1 9 0 2 0 1 0
1 36 0 2 0 0 1
1 12 12 2 0 0 0
1 51 6 2 0 0 1
1 2 0 2 0 0 1
0 45 0 0 0 0 1
0 18 0 0 0 0 1
0 3 0 0 0 0 0

1 8 0 0 0 2 0
1 40 0 2 0 0 1
1 5 0 2 0 0 0
1 6 1 2 0 0 0
1 7 0 2 0 0 0
1 33 0 2 0 0 1
0 2 2 2 0 0 0
0 3 3 2 0 0 0
0 2 2 2 0 0 0
0 22 0 0 1 0 1
0 31 0 0 1 0 1
0 6 0 0 1 0 0

0 3 0 0 0 0 0
0 2 1 0 0 0 0
0 6 0 0 0 0 0
1 5 0 1 0 2 0
1 27 0 1 0 0 1
1 2 0 1 0 0 1
1 3 0 1 0 0 1
1 19 0 1 0 0 1
1 6 0 1 0 1 0
1 44 2 1 0 0 1
0 4 4 1 0 0 0
0 3 3 1 0 0 0
0 33 0 0 1 0 1
0 7 1 0 0 0 0

0 4 4 0 0 0 0
0 6 6 0 0 0 0
0 17 14 0 0 0 0
1 21 0 0 0 0 1
1 17 0 0 0 0 1
1 25 1 0 0 0 1
0 16 9 0 0 0 0
0 9 5 0 0 0 0
0 11 0 0 0 0 0
0 3 0 0 0 0 0

0 5 0 0 1 1 0
0 28 0 0 1 0 1
0 64 0 0 1 0 1
1 11 0 2 0 2 0
1 130 0 2 0 0 1
1 90 0 2 0 0 0
0 12 0 0 1 0 1
0 75 2 0 1 0 1
0 52 0 0 1 0 1

0 2 0 0 0 0 0
0 3 0 0 0 1 0
0 4 0 0 0 0 0
0 5 0 0 0 0 0
0 2 2 0 0 0 0

0 2 2 0 1 0 0
0 9 0 0 1 0 1
1 8 0 0 0 2 0
1 66 2 0 0 0 1
0 24 0 0 1 0 1
1 18 0 0 0 0 1
1 2 0 0 0 0 1
1 39 0 0 0 0 0
1 4 0 0 0 1 0
1 57 0 0 0 0 1
0 41 0 0 1 0 1
0 83 1 0 1 0 1
0 3 0 0 1 1 0
0 50 0 0 1 0 0
0 12 3 0 1 0 1

0 3 0 0 1 0 0
0 34 0 0 1 0 1
1 22 0 0 0 0 1
1 47 3 0 0 0 1
0 8 8 0 0 0 1
0 10 9 0 0 0 1
0 7 7 0 0 0 0
0 19 16 0 0 0 1
0 3 0 0 0 0 1
0 4 0 0 0 0 1

0 2 2 0 0 0 0
0 4 4 0 0 0 0
1 5 0 0 0 2 0
1 16 0 0 0 0 1
1 19 0 0 0 0 1
1 3 0 0 0 0 1
1 20 0 0 0 0 1
1 4 0 0 0 1 0
1 15 1 0 0 0 1
1 33 0 0 0 0 1
1 29 2 0 0 0 1
0 4 0 0 0 0 0

1 3 0 0 0 2 0
1 12 0 0 0 0 1
1 15 0 0 0 0 1
1 2 0 0 0 1 0
1 24 0 0 0 0 1
1 70 2 0 0 0 1
1 18 0 0 0 0 1
0 3 3 0 0 0 0
0 12 11 0 0 0 0
0 24 21 0 0 0 1
0 6 1 0 0 0 0

0 60 0 0 1 0 1
0 13 0 0 1 0 1
0 20 0 0 1 0 0
0 1 1 0 1 0 0

1 10 0 0 0 0 1
1 12 0 0 0 0 1
1 9 0 0 0 0 1
1 14 0 0 0 0 1
0 4 0 0 0 0 0

1 5 0 2 0 2 0
1 1 0 2 0 0 1
1 2 0 2 0 0 1
0 8 0 0 0 0 0

0 3 3 0 1 0 0
1 4 0 2 0 2 0
1 41 0 2 0 0 1
1 6 0 2 0 0 0

1 6 0 2 0 2 0
1 19 5 2 0 0 1
1 3 0 2 0 1 0
1 28 9 2 0 0 1
1 110 0 2 0 0 1

1 4 0 1 0 2 0
1 35 2 1 0 0 1
1 8 0 1 0 0 1

1 7 0 0 0 2 0
1 52 1 0 0 0 1
1 31 0 0 0 0 1

0 2 2 0 1 0 0
1 23 0 2 0 0 1
1 4 0 2 0 0 0
0 30 0 0 0 0 1
0 50 2 0 0 0 1
0 64 0 0 0 0 1
0 25 25 0 0 0 0

1 1 0 2 0 0 1
1 2 0 2 0 0 1
"""


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled table."""
    x, y = [], []
    for page in TABLE.strip().split("\n\n"):
        rows = [tuple(map(int, line.split())) for line in page.splitlines()]
        y += [r[0] for r in rows]
        x.append(features([r[1:6] for r in rows], [bool(r[6]) for r in rows]))
    return np.concatenate(x), np.array(y)


class Tree:
    """A classification tree as arrays: feature (-1: leaf), threshold, children, value."""

    def __init__(self):
        self.feature, self.threshold, self.left, self.right, self.value = [], [], [], [], []

    def _node(self, x: np.ndarray, y: np.ndarray) -> int:
        me = len(self.value)
        for column, v in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.value, float(y.mean()))):
            column.append(v)
        best = None
        for f in range(x.shape[1]) if 0 < y.mean() < 1 else ():
            values = np.unique(x[:, f])
            for t in ((values[1:] + values[:-1]) / 2).tolist():
                low = x[:, f] <= t
                if min(low.sum(), (~low).sum()) < LEAF:
                    continue
                gini = sum(len(p) * p.mean() * (1 - p.mean()) for p in (y[low], y[~low]))
                if best is None or gini < best[0] - 1e-12:
                    best = gini, f, t
        if best is not None:
            _, f, t = best
            low = x[:, f] <= t
            self.feature[me], self.threshold[me] = f, t
            self.left[me] = self._node(x[low], y[low])
            self.right[me] = self._node(x[~low], y[~low])
        return me

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, threshold, left, right = (np.array(v) for v in (self.feature, self.threshold, self.left, self.right))
        at = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                return np.array(self.value)[at] >= 0.5
            node = at[inner]
            at[inner] = np.where(x[inner, feature[node]] <= threshold[node], left[node], right[node])

    def rules(self, node: int = 0, indent: str = "") -> str:
        """The tree as text."""
        if self.feature[node] < 0:
            return f"{indent}{'keep' if self.value[node] >= 0.5 else 'drop'}\n"
        name = f"{FEATURES[self.feature[node]]} <= {self.threshold[node]:g}"
        return (f"{indent}{name}:\n{self.rules(self.left[node], indent + '  ')}{indent}else:\n"
                f"{self.rules(self.right[node], indent + '  ')}")


def grow() -> Tree:
    """The tree of the labelled table."""
    tree = Tree()
    tree._node(*labelled())
    return tree


def main_text(html: str | None, tree: Tree) -> str:
    """The main text of one page."""
    if not html:
        return ""
    b = Blocks(html)
    if not b.texts:
        return ""
    keep = tree.predict(features(b.rows, [t.endswith(SENTENCE) for t in b.texts]))
    return "\n".join(t for t, k in zip(b.texts, keep.tolist()) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` of every page."""
    picked = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).cast("string").alias("html"))
    kinds = picked.schema
    schema = T.StructType([T.StructField(id_col, kinds[0].dataType), T.StructField(url_col, kinds[1].dataType),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    tree = grow()

    def work(batches):
        for b in batches:
            first, texts, size = 0, [], 0
            for i in range(b.num_rows):
                texts.append(main_text(b.column(2)[i].as_py(), tree))
                size += len(texts[-1])
                if size > OUT_BYTES or i == b.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(first, len(texts)), b.column(1).slice(first, len(texts)), pa.array(texts, pa.string()),
                         pa.array([len(t) for t in texts], pa.int64())], [id_col, url_col, "text", "n_chars"])
                    first, texts, size = i + 1, [], 0

    return picked.mapInArrow(work, schema)
