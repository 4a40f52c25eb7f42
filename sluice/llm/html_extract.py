"""Main text of web pages by a tree-structured graphical model over DOM nodes.

Every node is part of the page's frame (above the article), content, or something else. A parent-child
potential says how a node's state follows from its parent's, given the node's tag, whether it holds a
paragraph's worth of text outside links or has most of its text in links, and the words of its class,
id and role. Sum-product messages run from the leaves to the root and back; their product is each node's
exact marginal. Potentials are smoothed counts over labelled pages: a few pages of several makes written
below, and all pages of the table that mark their article themselves. Counts are added up in Spark.
Words and unusual tags are counted in ``BUCKETS`` buckets by their crc32, so what reaches the driver is
bounded whatever the table holds, and every word counts.

Text of nodes that are content with a marginal over one half is joined to blocks: one line per
block-level element, white space inside a block as one space.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import mapped

#: Buckets that class words and tags outside HTML share; two words meet in one in 1 of so many cases.
BUCKETS = 1 << 14
#: Characters outside links that make a node's text a paragraph's worth.
RICH = 80
#: States of a node.
FRAME, CONTENT, OTHER = STATES = (0, 1, 2)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea template noscript iframe svg math xmp noembed noframes".split())
#: Never text of a page, whatever the model says.
_MARKUP = frozenset("script style title textarea template noscript iframe svg math head select button noembed noframes object canvas audio video".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Start tags that end an open paragraph.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: A start tag that ends an open sibling of one of these tags, inside the nearest of the limits.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",)),
}
#: A quote opens a value only behind an equals sign; one that never ends takes the rest of the page.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?:=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s\"'>][^\s>]*+)?|[^>=])*+)(>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]{2,}")
#: Tags that are counted by their own names.
_TAGS = _VOID | _RAW | _MARKUP | _INLINE | _ENDS_P | frozenset("#root #text html head body li dt dd tr td th thead tbody tfoot caption colgroup legend summary label".split())


def bucket(word: str) -> str:
    """The bucket of a class word or of a tag that HTML does not know."""
    return f"w{zlib.crc32(word.encode('utf-8', 'surrogatepass')) % BUCKETS}"


class Tree:
    """Nodes in page order, parents first: parent, tag, class words, own text; node 0 is the root."""

    def __init__(self, source: str):
        self.parent, self.tag, self.words, self.text = [-1], ["#root"], [()], [""]
        at, n = 0, len(source)
        self._stack, self._open = [0], {"#root": [0]}
        while at < n:
            m = _TOKEN.search(source, at)
            self._add_text(self._stack[-1], source[at : m.start() if m else n])
            if not m:
                break
            at, tag = m.end(), (m[2] or "").lower()
            if not tag or not m[4]:
                continue
            if m[1]:
                self._close(tag)
                continue
            if tag in _ENDS_P:
                self._close("p", ("button", "td", "th", "table", "#root"))
            if tag in _ENDS:
                for sibling in _ENDS[tag][0]:
                    self._close(sibling, _ENDS[tag][1])
            node = self._add(self._stack[-1], tag, self._marks(m[3]))
            if tag in _RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                self._add_text(node, source[at : end.start() if end else n])
                at = end.end() if end else n
            elif tag not in _VOID and not m[3].endswith("/"):
                self._open.setdefault(tag, []).append(len(self._stack))
                self._stack.append(node)

    @staticmethod
    def _marks(attributes: str) -> tuple[str, ...]:
        if "=" not in attributes:
            return ()
        return tuple(sorted({w for m in _ATTRIBUTE.finditer(attributes) for w in _WORDS.findall((m[2] or m[3] or m[4] or "").lower())}))

    def _add(self, parent: int, tag: str, words: tuple = (), text: str = "") -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.words.append(words)
        self.text.append(text)
        return len(self.tag) - 1

    def _add_text(self, parent: int, text: str) -> None:
        if text:
            self._add(parent, "#text", (), text if self.tag[parent] in ("script", "style") else html.unescape(text))

    def _close(self, tag: str, limits: tuple = ()) -> None:
        """Close the innermost open element of a tag, unless one of the limits is further in.

        Every tag knows where it is open, so a stray end tag costs nothing and an element is closed once.
        """
        innermost = lambda name: (self._open.get(name) or (-1,))[-1]
        at = innermost(tag)
        if at < 1 or any(innermost(x) > at for x in limits):
            return
        for node in self._stack[at:]:
            self._open[self.tag[node]].pop()
        del self._stack[at:]

    def kinds(self) -> list[str]:
        """Tag of each node, whether it has class words, and what its text is like."""
        size, linked = [0] * len(self.tag), [0] * len(self.tag)
        for i in range(len(self.tag) - 1, 0, -1):
            if self.tag[i] == "#text":
                size[i] = 0 if self.tag[self.parent[i]] in _MARKUP else len(self.text[i].strip())
            if self.tag[i] == "a":
                linked[i] = size[i]
            size[self.parent[i]] += size[i]
            linked[self.parent[i]] += linked[i]
        out = []
        for t, w, s, k in zip(self.tag, self.words, size, linked):
            name = t if t in _TAGS else bucket(t)
            like = "" if t in ("a", "#root") else "~links" if s and 2 * k > s else "~rich" if s - k >= RICH else ""
            out.append(name + ("." if w else "") + like)
        return out


#: Labelled pages: what is inside an element marked ``data-main="1"`` is content, ``"0"`` is not.
SEED_PAGES = (
    '<html><body><header class="site header"><h1>Site</h1><a>home</a></header><nav class="menu"><ul><li><a>x</a></li></ul></nav><main data-main="1"><h1>T</h1><p>t <b>b</b> <a>l</a></p><ul><li>t</li></ul><aside data-main="0" class="sidebar"><p>t</p></aside></main><aside class="sidebar related"><h2>x</h2><p>t</p></aside><footer><p>t</p></footer></body></html>',
    '<html><body><div class="cookie notice banner"><p>t</p></div><div class="menu nav"><a>x</a></div><article data-main="1"><header data-main="0"><p>t</p></header><h2>T</h2><p>t <em>e</em><span>s</span></p><blockquote><p>q</p></blockquote><div data-main="0" class="ad advert ads advertisement sponsor promo"><p>t</p></div><form data-main="0"><label>t</label><p>t</p></form><footer data-main="0"><p>t</p></footer></article><section data-main="0" class="comments comment discussion replies"><h3>x</h3><article><p>t</p></article><div class="comment"><p>t</p></div></section><footer class="footer"><p>t</p></footer></body></html>',
    '<html><body><div class="header masthead"><p>t</p></div><div class="content post entry article main story" data-main="1"><h1>T</h1><p>t</p><table><tr><td>t</td></tr></table><pre>t</pre><ol><li>t</li></ol><div><p>t</p></div><figure><figcaption>t</figcaption></figure><nav data-main="0"><a>x</a></nav><div data-main="0" class="share social newsletter subscribe popup"><p>t</p></div><div data-main="0" class="comments"><p>t</p></div></div><div class="sidebar widget"><p>t</p></div><div class="footer copyright"><p>t</p></div></body></html>',
    '<html><body><div role="banner"><p>t</p></div><div role="navigation"><a>x</a></div><div role="main" data-main="1"><section><h2>t</h2><p>t<br>t</p><dl><dt>t</dt><dd>t</dd></dl></section><aside data-main="0"><p>t</p></aside><div data-main="0" class="ad"><p>t</p></div><div data-main="0" class="notice warning cookie consent"><p>t</p></div></div><div role="complementary"><p>t</p></div><div role="contentinfo"><p>t</p></div><form><p>t</p></form></body></html>',
    # Makes without landmarks: what tells the article is its text.
    '<html><body><h1 data-main="1">T</h1><p data-main="1">LONG</p><p data-main="1">LONG <a>l</a></p><p data-main="1">t</p><h2 data-main="1">t</h2><p data-main="1">LONG</p><p data-main="0"><a>x</a> <a>x</a></p><ul data-main="0"><li><a>x</a></li></ul></body></html>',
    '<html><body><div class="wrapper"><div class="top"><a>x</a></div><div class="post body text entry" data-main="1"><h1>T</h1><p>LONG</p><p>t</p><p>LONG</p></div><div class="right"><p>t</p><ul><li><a>x</a></li></ul></div></div></body></html>',
    '<html><body><table><tr><td data-main="0">t</td></tr><tr><td data-main="0"><a>x</a><br><a>x</a></td><td data-main="1"><h1>T</h1><p>LONG</p><p>LONG</p><p>t</p></td></tr><tr><td data-main="0">t</td></tr></table></body></html>',
    '<html><body><center data-main="0"><a>x</a> <a>x</a></center><div data-main="1"><font><b>T</b><br>LONG<br>LONG</font></div><div data-main="0">t</div></body></html>',
    '<html><body><div><div data-main="0"><a>x</a></div><div><div data-main="1"><h1>T</h1><div>LONG</div><div>LONG</div><div>t</div></div></div><div data-main="0"><span>t</span></div></div></body></html>',
)
_SEED_WEIGHT, _TABLE_WEIGHT = 20, 40
#: An unknown kind of node mostly goes with its parent. Rows: parent's state; columns: its own.
_UNKNOWN = ((0.5, 0.1, 0.4), (0.001, 0.969, 0.03), (0.001, 0.009, 0.99))
#: Landmarks by which pages label themselves, and the elements inside them that are not content.
_MAIN = frozenset(("article",))
_OTHER = frozenset("nav aside footer header form menu dialog".split())
_OTHER_WORDS = frozenset("ad ads advert advertisement sidebar comment comments cookie notice menu nav banner share promo related popup footer header".split())


def _labels(tree: Tree, marked: list[str | None] | None = None) -> list[int] | None:
    """State of each node of a page that labels itself (or whose marks are given), or None."""
    if marked is None and not _MAIN & set(tree.tag):
        return None
    state = [OTHER] * len(tree.tag)
    # Whether a node stands inside an element that is not content, such as a comment.
    blocked = [False] * len(tree.tag)
    for i in range(1, len(state)):
        p = tree.parent[i]
        aside = tree.tag[i] in _OTHER or not _OTHER_WORDS.isdisjoint(tree.words[i])
        blocked[i] = blocked[p] or aside
        if marked:
            own = {"1": CONTENT, "0": OTHER}.get(marked[i] or "")
        elif aside:
            own = OTHER
        else:
            own = CONTENT if tree.tag[i] in _MAIN and not blocked[i] else None
        state[i] = (state[p] if state[p] == CONTENT else OTHER) if own is None else own
        if state[i] == CONTENT and state[p] != CONTENT:
            while p >= 0 and state[p] == OTHER:
                state[p], p = FRAME, tree.parent[p]
    state[0] = FRAME
    return state


def _counts(tree: Tree, state: list[int], weight: int, out: Counter) -> None:
    kinds = tree.kinds()
    for i in range(1, len(state)):
        out["edge", kinds[i], state[tree.parent[i]], state[i]] += weight
        for w in tree.words[i]:
            out["word", bucket(w), state[tree.parent[i]], state[i]] += weight


def _seed_counts() -> Counter:
    out: Counter = Counter()
    for page in SEED_PAGES:
        page = page.replace("LONG", "long text " * 20)
        tree = Tree(re.sub(r'\sdata-main="(.)"', r' role="datamark\1"', page))
        names = {"datamark": None}
        marks = [m for m in re.finditer(r"<([a-z][a-z0-9]*)([^>]*)>", page)]
        flags = [re.search(r'data-main="(.)"', m[2]) for m in marks]
        starts = [i for i, t in enumerate(tree.tag) if t not in ("#text", "#root")]
        marked: list[str | None] = [None] * len(tree.tag)
        for i, f in zip(starts, flags):
            marked[i] = f[1] if f else None
        tree.words = [tuple(w for w in ws if w not in names) for ws in tree.words]
        _counts(tree, _labels(tree, marked), _SEED_WEIGHT, out)
    return out


def train(pages: DataFrame, html_col: str = "html") -> dict:
    """Potentials from the seed pages and from every page of the table that labels itself."""

    def count(batches):
        out: Counter = Counter()
        for batch in batches:
            for source in batch.column(0):
                tree = Tree(source.as_py() or "")
                state = _labels(tree)
                if state:
                    _counts(tree, state, 1, out)
        if out:
            kind, name, up, down = zip(*out)
            yield pa.RecordBatch.from_pydict({"kind": kind, "name": name, "up": pa.array(up, pa.int32()), "down": pa.array(down, pa.int32()), "n": pa.array(out.values(), pa.int64())})

    rows = mapped(pages.select(html_col), count, "kind string, name string, up int, down int, n long")
    total = rows.groupBy("kind", "name", "up", "down").agg(F.sum("n").alias("n")).collect()
    mine: dict[tuple, list] = {}
    for (kind, name, up, down), n in _seed_counts().items():
        mine.setdefault((kind, name, up), [0.0] * 3)[down] += n
    theirs: dict[tuple, list] = {}
    for r in total:
        theirs.setdefault((r["kind"], r["name"], r["up"]), [0.0] * 3)[r["down"]] += r["n"]
    # The table's pages weigh as much as a few written ones per kind, so that pages of one make do not
    # decide what other makes look like.
    for key, row in theirs.items():
        scale = min(1.0, _TABLE_WEIGHT / sum(row))
        mine[key] = [a + scale * b for a, b in zip(mine.get(key, [0.0] * 3), row)]
    share = lambda row, prior, k: [(x + k * p) / (sum(row) + k) for x, p in zip(row, prior)]
    edge, word = {}, {}
    for (kind, name, up), row in mine.items():
        if kind == "edge":
            edge.setdefault(name, [list(r) for r in _UNKNOWN])[up] = share(row, _UNKNOWN[up], 2.0)
        else:
            # A class word weighs by how it changes the state expected of any node below such a parent.
            word.setdefault(name, [[0.0] * 3 for _ in STATES])[up] = [math.log(x / g) for x, g in zip(share(row, _UNKNOWN[up], 2.0), _UNKNOWN[up])]
    return {"edge": edge, "word": word}


def marginals(tree: Tree, model: dict) -> list[float]:
    """Probability of each node to be content, by one upward and one downward pass of messages."""
    n, kinds = len(tree.tag), tree.kinds()
    psi = []
    for i in range(n):
        table = model["edge"].get(kinds[i]) or model["edge"].get(kinds[i].split("~")[0]) or _UNKNOWN
        known = [model["word"][b] for b in map(bucket, tree.words[i]) if b in model["word"]]
        if known:
            table = [[x * math.exp(max(-30.0, min(30.0, sum(k[up][s] for k in known)))) for s, x in enumerate(row)] for up, row in enumerate(table)]
        psi.append(table)
    below = [[1.0] * 3 for _ in range(n)]
    message = [[1.0] * 3 for _ in range(n)]
    for i in range(n - 1, 0, -1):
        b0, b1, b2 = below[i]
        m = [r[0] * b0 + r[1] * b1 + r[2] * b2 for r in psi[i]]
        scale = sum(m) or 1.0
        m = message[i] = [max(x / scale, 1e-30) for x in m]
        p = below[tree.parent[i]]
        for s in STATES:
            p[s] *= m[s]
        if max(p) < 1e-100:
            top = max(p) or 1.0
            p[:] = [max(x / top, 1e-150) for x in p]
    # The root is the page itself, the outermost frame.
    belief = [[1.0, 0.0, 0.0]] + [[0.0] * 3] * (n - 1)
    for i in range(1, n):
        above = [u / m for u, m in zip(belief[tree.parent[i]], message[i])]
        b = [sum(a * row[s] for a, row in zip(above, psi[i])) * below[i][s] for s in STATES]
        total = sum(b) or 1.0
        belief[i] = [x / total for x in b]
    return [b[CONTENT] for b in belief]


def main_text(source: str, model: dict) -> str:
    """Blocks of content in page order, one per line."""
    tree = Tree(source)
    content = marginals(tree, model)
    hidden = [False] * len(content)
    block = [0] * len(content)
    lines: list[list[str]] = []
    last = None
    opened = 0
    for i in range(1, len(content)):
        p, tag = tree.parent[i], tree.tag[i]
        hidden[i] = hidden[p] or tag in _MARKUP
        if tag == "#text" or tag in _INLINE:
            block[i] = block[p]
        else:
            opened += 1
            block[i] = opened
        # A block-level element between two texts of one block ends the line.
        if tag not in _INLINE and tag != "#text":
            last = None
        if tag == "br" and last is not None and last == block[p]:
            lines[-1].append(" ")
        if tag == "#text" and not hidden[i] and content[i] > 0.5:
            if last != block[i] or not lines:
                lines.append([])
                last = block[i]
            lines[-1].append(tree.text[i])
    joined = (" ".join("".join(x).split()) for x in lines)
    return "\n".join(x for x in joined if x)


def extracted(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """``(id, url, text, n_chars)`` per row of ``pages``; a null or empty page has an empty text.

    Pages cut off anywhere, stray end tags and unclosed elements are read as browsers do, roughly.
    Character references are decoded once. Equal rows are given alike; an empty table gives no rows;
    other columns are ignored.
    """
    model = pages.sparkSession.sparkContext.broadcast(train(pages, html_col))
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def extract(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [main_text(h.as_py() or "", model.value) for h in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return mapped(rows, extract, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
