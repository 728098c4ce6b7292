"""Main text of web pages: sum-product on the tree of the page, with potentials learned from labelled pages."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import read, unit
from gazette.llm.html_pages import MARK, labelled_pages

#: Pages of the table that teach the model besides the labelled ones, at most about; how often a name has to occur in them.
TRAIN_PAGES, LEAST = 2_000, 2
#: Fixed values of HTML: elements without an end, elements that start a new block, elements that never hold text of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
SILENT = frozenset("applet audio base button canvas datalist embed head iframe input map meta noembed noframes noscript object option script select style svg template textarea title video".split())
#: Fixed values of HTML: a start tag ends the open elements named, up to the nearest of the elements after them.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Elements whose shape is looked at: length of text, share of it in links, ends of sentences.
HOLDERS = frozenset("article aside body center div footer form header main nav ol section table ul".split())
_AROUND_P = {"article", "aside", "body", "button", "div", "main", "nav", "section", "table", "td", "th", "li", "header", "footer", "form", "blockquote", "figure"}
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: A comment, a declaration or processing instruction, or a tag: slash, name, attributes.
_MARKUP = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_UNSEEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")
#: Elements whose content is no markup, and where they end.
_RAW = {x: re.compile(rf"(?i)</{x}(?=[\s/>])") for x in ("script", "style", "xmp", "iframe", "noembed", "noframes", "textarea", "title")}
#: Potential of the whole page: other, main text, around it.
ROOT = (0.05, 0.15, 0.8)
_STRONG_MAIN, _STRONG_OTHER = {"article", "main"}, {"nav", "footer", "aside", "form"}


class Tree:
    """Nodes of a page in document order: elements and, with tag ``#``, pieces of text. A parent comes before its children.

    Every page gives a tree, in time in proportion to its length: comments, declarations and elements that are never
    closed end with the page, end tags without a start are left out (``</p>`` is an empty paragraph), and what is no
    markup is text.
    """

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.names, self.text, self.marks = ["#root"], [-1], [()], [""], [""]
        self.unseen: set[int] = set()  # elements that say themselves that they are not shown
        self.open = [0]
        self.places: dict[str, list[int]] = defaultdict(list)  # where in ``open`` the open elements of each tag are
        at = 0
        while at < len(html):
            found = _MARKUP.search(html, at)
            self.data(html[at : found.start() if found else len(html)])
            if not found:
                break
            at = found.end()
            name = found[2]
            if not name or html[at - 1] != ">":
                continue
            name = name.lower()
            if found[1]:
                self.end(name)
                continue
            self.start(name, found[3])
            if name in _RAW:
                end = _RAW[name].search(html, at)
                inside, at = html[at : end.start() if end else len(html)], end.start() if end else len(html)
                if name in ("textarea", "title"):
                    self.data(inside)
                elif not end:
                    break

    def add(self, tag: str, names: tuple[str, ...] = (), text: str = "", mark: str = "") -> int:
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.names.append(names)
        self.text.append(text)
        self.marks.append(mark)
        return len(self.tag) - 1

    def data(self, text: str) -> None:
        if text:
            self.add("#", text=unescape(text))

    def nearest(self, tags: Iterable[str]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, place: int) -> None:
        for node in self.open[place:]:
            self.places[self.tag[node]].pop()
        del self.open[place:]

    def start(self, tag: str, rest: str) -> None:
        wanted, limit = ENDS.get(tag) or ((("p",), _AROUND_P) if tag in BLOCK and tag != "br" else ((), ()))
        if (place := self.nearest(wanted)) > self.nearest(limit):
            self.close(place)
        names, mark, unseen = set(), "", False
        for key, *values in _ATTRIBUTE.findall(rest):
            key, value = key.lower(), "".join(values)
            if key in ("class", "id", "role") and value:
                names.update(x.lower() for x in _NAME.findall(value))
            elif key == MARK:
                mark = "main"
            elif key == "data-other":
                mark = "other"
            elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and _UNSEEN.search(value):
                unseen = True
        node = self.add(tag, tuple(sorted(names)), mark=mark)
        if unseen:
            self.unseen.add(node)
        if tag not in VOID:
            self.places[tag].append(len(self.open))
            self.open.append(node)

    def end(self, tag: str) -> None:
        if place := self.nearest((tag,)):
            self.close(place)
        elif tag in ("p", "br"):
            self.add(tag)


def _bucket(x: float) -> int:
    return min(9, int(math.log2(x + 1)))


def observed(tree: Tree) -> tuple[list[tuple[str, ...]], list[bool], list[int]]:
    """Features of each node; whether it can hold no main text; the length of the text below it."""
    n = len(tree.tag)
    size, linked, ends, main = [0] * n, [0] * n, [0] * n, [False] * n
    for k in range(n - 1, 0, -1):
        tag = tree.tag[k]
        if tag == "#":
            size[k] = len(tree.text[k].strip())
            ends[k] = tree.text[k].count(". ") + tree.text[k].rstrip().endswith((".", "!", "?"))
        elif tag == "a":
            linked[k] = size[k]
        elif tag in ("script", "style", "noscript", "template", "title"):
            continue
        up = tree.parent[k]
        main[up] |= main[k] or tag in ("article", "main", "h1")
        size[up] += size[k]
        linked[up] += linked[k]
        ends[up] += ends[k]
    silent = [False] * n
    found: list[tuple[str, ...]] = [()] * n
    for k in range(1, n):
        tag = tree.tag[k]
        silent[k] = silent[tree.parent[k]] or tag in SILENT or k in tree.unseen
        if tag == "#":
            continue
        share = linked[k] * 4 // size[k] if size[k] else 5
        found[k] = tuple(f"name {x}" for x in tree.names[k])
        if tag in HOLDERS:  # of many small elements the shape tells little, and each would count
            found[k] += (f"size {_bucket(size[k] / 8)}", f"linked {share}", f"ends {min(3, ends[k])}", f"holds {int(main[k])}")
    return found, silent, size


def taught(html: str, marked: bool) -> Counter:
    """Counts of one page: ("f", tag, feature, label) and ("t", tag, parent's label, label).

    Labels: 1 for main text and the elements within its container, 2 for elements around it, 0 for all else. With
    ``marked``, main text is under ``data-main``. Without, the page's own elements tell: article and main hold main
    text, but not navigation, footers, asides and forms in them; pages without them teach nothing.
    """
    tree = Tree(html)
    n = len(tree.tag)
    out: Counter = Counter()
    if not marked and not _STRONG_MAIN & set(tree.tag):
        return out
    found, silent, size = observed(tree)
    inside = [0] * n
    main = [0] * n
    for k in range(1, n):
        inside[k] = inside[tree.parent[k]]
        if marked:
            inside[k] = {"main": 1, "other": 0}.get(tree.marks[k], inside[k])
        elif tree.tag[k] in _STRONG_MAIN:
            inside[k] = inside[tree.parent[k]] if any(x.startswith("comment") for x in tree.names[k]) else 1
        elif tree.tag[k] in _STRONG_OTHER:
            inside[k] = 0
    for k in range(n - 1, 0, -1):
        if tree.tag[k] == "#":
            main[k] = size[k] * inside[k] * (not silent[k])
        main[tree.parent[k]] += main[k]
    label = [2] * n
    for k in range(1, n):
        label[k] = (1 if inside[k] else 2) if main[k] else 0
        if size[k] and not silent[k]:
            tag = tree.tag[k]
            out["t", tag, label[tree.parent[k]], label[k]] += 1
            for f in found[k]:
                out["f", "" if f.startswith("name") else tag, f, label[k]] += 1
    return out


def learn(pages: DataFrame, bound: int = TRAIN_PAGES, least: int = LEAST) -> dict[tuple, float]:
    """Counts for the potentials: from the labelled pages, and from about ``bound`` of ``pages`` whose own elements tell.

    Counts are made by batch and summed on Spark. All moves between labels are kept, and all features that occur
    ``least`` times; there are no more than the bounded sample has.
    """
    spark = pages.sparkSession
    total = pages.count()
    share = unit(F.lit(2), F.xxhash64("html")) < F.lit(bound / max(1, total))
    own = pages.filter(share & F.col("html").isNotNull()).select("html", F.lit(False).alias("marked"))
    given = spark.createDataFrame([(x, True) for x in labelled_pages()], "html string, marked boolean")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums: Counter = Counter()
            for html, marked in zip(batch.html, batch.marked, strict=True):
                for key, n in taught(html, marked).items():
                    sums[*key[:2], str(key[2]), key[3]] += n
            rows = [(*key, n) for key, n in sums.items()]
            yield pd.DataFrame(rows, columns=["kind", "tag", "what", "label", "n"])

    counted = own.union(given).mapInPandas(count, "kind string, tag string, what string, label int, n long")
    rows = counted.groupBy("kind", "tag", "what", "label").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) | (F.col("kind") == "t")).collect()
    return {(r.kind, r.tag, r.what, r.label): float(r.n) for r in rows}


class Model:
    """Potentials: of a node's features given its label, and of its label given its tag and its parent's label."""

    def __init__(self, counts: dict[tuple, float]) -> None:
        groups, moves = Counter(), Counter()
        for (kind, tag, what, label), n in counts.items():
            if kind == "t":
                moves[tag, int(what), label] += n
                moves["", int(what), label] += n
            else:
                groups[tag, what.split(" ")[0], label] += n
        self.pair: dict[str, tuple] = {}
        for tag in {"", *(t for t, _, _ in moves)}:
            rows = []
            for up in range(3):
                total = sum(moves["", up, y] for y in range(3)) + 3
                prior = [(moves["", up, y] + 1) / total for y in range(3)]
                seen = sum(moves[tag, up, y] for y in range(3))
                rows.append(tuple((moves[tag, up, y] + 2 * prior[y]) / (seen + 2) for y in range(3)))
            self.pair[tag] = tuple(rows)
        self.unary: dict[tuple[str, str], tuple[float, float]] = {}
        for kind, tag, what, _ in counts:
            if kind == "f" and (tag, what) not in self.unary:
                group = what.split(" ")[0]
                weight, more = (1.0, 0.2) if group == "name" else (0.3, 1.0)  # what an element is called tells more than its size
                share = [(counts.get(("f", tag, what, y), 0.0) + more) / (groups[tag, group, y] + 5 * more) for y in range(3)]
                self.unary[tag, what] = tuple(max(-4.0, min(4.0, weight * math.log(share[y] / share[0]))) for y in (1, 2))

    def marginals(self, tree: Tree) -> list[float]:
        """The probability that each node is main text. Messages go up from the leaves, then down from the root.

        Where no text is likely to be, it is the probability given that the page has some main text at all.
        """
        seen = observed(tree)
        out, all_ways = self.passed(tree, seen)
        texts = [x for x, tag in zip(out, tree.tag, strict=True) if tag == "#"]
        if texts and 0.02 < max(texts) < 0.5:
            none = math.exp(self.passed(tree, seen, False)[1] - all_ways)
            out = [min(1.0, x / max(1e-9, 1 - none)) for x in out]
        return out

    def passed(self, tree: Tree, seen: tuple, texts: bool = True) -> tuple[list[float], float]:
        """The marginals, and the logarithm of the sum of all labellings; without ``texts`` of those without main text."""
        n = len(tree.tag)
        found, silent, size = seen
        total = 0.0
        pair, unary = self.pair, self.unary
        usual = pair[""]
        got = [(1.0, 1.0, 1.0)] * n  # a node's own potential with what its children sent
        up = [(1.0, 1.0, 1.0)] * n  # what a node sends to its parent
        live = [k for k in range(1, n) if size[k] and not silent[k]]
        for k in reversed(live):
            tag = tree.tag[k]
            g0, g1, g2 = got[k]
            if tag == "#":
                g1, g2 = g1 * texts, 0.0
            else:
                one = two = 0.0
                for f in found[k]:
                    odds = unary.get(("" if f[0] == "n" else tag, f))
                    if odds:
                        one += odds[0]
                        two += odds[1]
                g1 *= math.exp(max(-12.0, min(12.0, one)))
                g2 *= math.exp(max(-12.0, min(12.0, two)))
            scale = g0 + g1 + g2
            total += math.log(scale)
            g0, g1, g2 = g0 / scale, g1 / scale, g2 / scale
            got[k] = (g0, g1, g2)
            a, b, c = pair.get(tag, usual)
            sent = (a[0] * g0 + a[1] * g1 + a[2] * g2, b[0] * g0 + b[1] * g1 + b[2] * g2, c[0] * g0 + c[1] * g1 + c[2] * g2)
            up[k] = sent
            p = tree.parent[k]
            x = got[p]
            x = (x[0] * sent[0], x[1] * sent[1], x[2] * sent[2])
            scale = x[0] + x[1] + x[2] or 1.0
            total += math.log(scale)
            got[p] = (x[0] / scale, x[1] / scale, x[2] / scale)
        belief = [(1.0, 0.0, 0.0)] * n
        belief[0] = tuple(x * y for x, y in zip(ROOT, got[0], strict=True))
        total += math.log(sum(belief[0]) or 1.0)
        if not texts:
            return [], total
        out = [0.0] * n
        for k in live:
            p, sent = tree.parent[k], up[k]
            x, y, z = belief[p]
            x, y, z = x / max(sent[0], 1e-300), y / max(sent[1], 1e-300), z / max(sent[2], 1e-300)
            a, b, c = pair.get(tree.tag[k], usual)
            g = got[k]
            v = (g[0] * (x * a[0] + y * b[0] + z * c[0]), g[1] * (x * a[1] + y * b[1] + z * c[1]), g[2] * (x * a[2] + y * b[2] + z * c[2]))
            scale = v[0] + v[1] + v[2] or 1.0
            belief[k] = (v[0] / scale, v[1] / scale, v[2] / scale)
            out[k] = belief[k][1]
        return out, total

    def text(self, html: str | None, least: float = 0.5) -> str:
        """The text of all nodes that are main text with probability ``least`` or more: white space in a block becomes one space, blocks are joined by one."""
        tree = Tree(html or "")
        chance = self.marginals(tree) if any(t not in ("#", "#root") for t in tree.tag) else [1.0] * len(tree.tag)  # no element at all: plain text
        blocks: list[list[str]] = [[]]
        last = -1
        above = [0] * len(tree.tag)  # the block that a node is in
        for k in range(1, len(tree.tag)):
            tag = tree.tag[k]
            above[k] = k if tag in BLOCK else above[tree.parent[k]]
            if tag in BLOCK:  # also an empty or left out one parts what stands before and after it
                last = -1
            if tag == "#" and chance[k] >= least:
                if above[k] != last:
                    blocks.append([])
                    last = above[k]
                blocks[-1].append(tree.text[k])
        return " ".join(x for x in (" ".join("".join(b).split()) for b in blocks) if x)


def extract(pages: DataFrame, counts: dict[tuple, float] | None = None) -> DataFrame:
    """page_id, url, text, n_chars: the main text of every page. Null and empty pages, and pages without main text, have an empty text.

    Unclosed elements end as in HTML; text in elements that a browser does not show is never main text. Markup that is
    broken or cut off loses no text but its own. Repeated rows give repeated rows; other columns are not looked at; no
    rows give no rows.
    """
    model = Model(counts if counts is not None else learn(pages))

    @F.pandas_udf("string")
    def run(htmls: pd.Series) -> pd.Series:
        return pd.Series([model.text(x) for x in htmls], dtype=object)

    rows = pages.select("page_id", "url", run("html").alias("text"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
