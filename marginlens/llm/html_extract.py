"""Main-text extraction by tree scoring.

The page is parsed once into a flat tree. Blocks of boilerplate elements
(menus, page headers and footers, sidebars, notices, adverts, forms, scripts,
styles, reader comments; by element, role or class word; inside an article by
the class words of containers only, never by an id) are taken out. Every
remaining text block passes points -- for its length and its commas -- to its
ancestors, halved and then thinned with distance. An ancestor's points are
discounted by its link density; the best container is kept, widened to the
``article`` or ``main`` around it, and siblings that score near it or read
like prose are kept with it.

Text: character references decoded, white space inside a block turned into one
space, trimmed, blocks joined by one space in page order.

Defined cases: null, empty or tag-only pages give the empty text; a text
without tags is its own main text; unclosed and stray tags are tolerated;
equal rows give equal results; an empty table gives an empty result.
"""
from __future__ import annotations

import html as html_lib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlens.llm.common import driver_table, ship_package

# --- fixed values: element classes of the HTML standard ---
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCK = set("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option optgroup p pre section
    select summary table tbody td tfoot th thead title tr ul""".split())
CLOSES_P = BLOCK - set("option optgroup legend".split())
#: An opening tag that ends an open element of the same list, up to the scope element.
SAME_LEVEL = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
              "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
              "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
              "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
              "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}
# --- fixed values: what counts as boilerplate, and as content ---
DROP = set("""nav footer aside form script style noscript iframe template button select textarea input svg canvas
    object embed head title dialog menu noembed noframes fieldset datalist audio video map""".split())
DROP_ROLES = set("""navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar
    form status""".split())
DROP_WORDS = set("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion
    banner sidebar side aside rail comment comments commentlist discussion disqus respond reply replies footer
    footnav header masthead topbar menu navbar nav navigation breadcrumb breadcrumbs pager pagination toc notice
    notices cookie cookies consent gdpr popup modal overlay share sharing social related recommended newsletter
    subscribe subscription signup login search widget widgets toolbar skip alert disclaimer paywall""".split())
KEEP_WORDS = set("article content main post story entry body text prose".split())
CONTENT_TAGS = {"article", "main"}
#: Elements that a class word takes out of an article; its headings, paragraphs and inline elements stay.
WORD_TAGS = {"div", "section", "header", "center", "ul", "ol", "dl", "table", "figure", "details"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that may be the container, with their starting points.
CONTAINERS = {"article": 25.0, "main": 25.0, "div": 5.0, "section": 5.0, "center": 3.0, "body": 0.0, "#root": 0.0}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
                    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_WORD = re.compile(r"[a-z]+")
DEPTH = 6  # ancestors that a block's points reach


def _words(names: str) -> set[str]:
    return set(_WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", names).lower()))


class Tree:
    """Nodes in page order; ``items`` are (node, text) runs, text None for a line break."""

    def __init__(self, page: str):
        self.tag, self.up, self.drop, self.end = ["#root"], [-1], [False], [0]
        self.named: set[int] = set()  # nodes with a boilerplate word in class or id
        self.runs: list[tuple[int, str]] = []
        self._parse(page)

    def _open(self, tag: str, attrs: str, parent: int) -> int:
        self.tag.append(tag)
        self.up.append(parent)
        self.drop.append(self._boilerplate(tag, attrs, parent))
        self.end.append(0)
        return len(self.tag) - 1

    def _boilerplate(self, tag: str, attrs: str, parent: int) -> bool:
        if self.drop[parent] or tag in DROP:
            return True
        if tag == "header" and not self._inside(parent, CONTENT_TAGS):
            return True
        if not attrs or not attrs.strip() or tag in ("html", "body"):
            return False
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
        if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
            return True
        if set(found.get("role", "").lower().split()) & DROP_ROLES:
            return True
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
            return True
        if tag in CONTENT_TAGS:
            return False
        tokens = _words(f"{found.get('class', '')} {found.get('id', '')}")
        if not tokens & DROP_WORDS:
            return False
        self.named.add(len(self.tag) - 1)
        if self._inside(parent, CONTENT_TAGS):  # an id there is as often the slug of a heading
            tokens = _words(found.get("class", "")) if tag in WORD_TAGS else set()
        return bool(tokens & DROP_WORDS) and (not tokens & KEEP_WORDS or bool(tokens & {"comment", "comments"}))

    def _inside(self, node: int, tags: set) -> bool:
        while node > 0:
            if self.tag[node] in tags:
                return True
            node = self.up[node]
        return False

    def _close_to(self, stack: list[int], tags: set, scope: set) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[depth]]
            if name in tags:
                self._pop(stack, depth)
                return
            if name in scope:
                return

    def _pop(self, stack: list[int], depth: int) -> None:
        for node in stack[depth:]:
            self.end[node] = len(self.tag)
        del stack[depth:]

    def _parse(self, page: str) -> None:
        stack, at = [0], 0
        while True:
            m = _TOKEN.search(page, at)
            text = page[at:m.start()] if m else page[at:]
            if text:
                self.runs.append((stack[-1], html_lib.unescape(text)))
            if not m:
                break
            at = m.end()
            if m[1]:
                self._end_tag(stack, m[1].lower())
            elif m[2]:
                tag, attrs = m[2].lower(), m[3] or ""
                if tag in CLOSES_P:
                    self._close_to(stack, {"p"}, {"td", "th", "button", "li", "dd", "div", "article", "section", "body"})
                if tag in SAME_LEVEL:
                    tags, scope = SAME_LEVEL[tag]
                    while (before := len(stack)) and (self._close_to(stack, tags, scope) or len(stack) < before):
                        pass
                node = self._open(tag, attrs, stack[-1])
                if tag in VOID or attrs.rstrip().endswith("/") and tag not in BLOCK | RAW:
                    self.end[node] = len(self.tag)
                    if tag in ("br", "hr", "wbr"):
                        self.runs.append((stack[-1], " " if tag != "wbr" else ""))
                elif tag in RAW:
                    close = _RAW_END[tag].search(page, at)
                    body = page[at:close.start()] if close else page[at:]
                    if not self.drop[node]:
                        self.runs.append((node, html_lib.unescape(body)))
                    at = close.start() if close else len(page)
                    stack.append(node)
                else:
                    stack.append(node)
            elif m[0].startswith("<![CDATA["):
                self.runs.append((stack[-1], m[0][9:].removesuffix("]]>")))
        self._pop(stack, 0)

    def _end_tag(self, stack: list[int], tag: str) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[depth]]
            if name == tag:
                self._pop(stack, depth)
                return
            if name in ("table", "td", "th", "article", "main", "nav", "aside", "footer", "form", "section") \
                    and tag not in BLOCK:
                return  # a stray inline end tag closes nothing outside its section


def _block_of(tree: Tree) -> list[int]:
    """The nearest block element of every node (itself included)."""
    block = [0]
    for node in range(1, len(tree.tag)):
        block.append(node if tree.tag[node] in BLOCK else block[tree.up[node]])
    return block


def main_text(page: str | None) -> str:
    if not page:
        return ""
    tree = Tree(page)
    block = _block_of(tree)
    n = len(tree.tag)
    in_link = [False] * n
    for node in range(1, n):
        in_link[node] = in_link[tree.up[node]] or tree.tag[node] == "a"

    # consecutive runs of one block element make one text block
    parts: list[tuple[int, list[str]]] = []
    chars, links = [0] * n, [0] * n
    for node, text in tree.runs:
        if tree.drop[node]:
            continue
        if parts and parts[-1][0] == block[node]:
            parts[-1][1].append(text)
        else:
            parts.append((block[node], [text]))
        size = len(text.strip())
        chars[node] += size
        links[node] += size if in_link[node] else 0
    texts = [(b, " ".join("".join(t).split())) for b, t in parts]
    texts = [(b, t) for b, t in texts if t]
    if not texts:
        return ""
    for node in range(n - 1, 0, -1):  # children come after parents
        chars[tree.up[node]] += chars[node]
        links[tree.up[node]] += links[node]

    points: dict[int, float] = {}
    for b, text in texts:
        if tree.tag[b] in HEADINGS:
            continue
        worth = 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)
        node, level = b, 0
        while node >= 0 and level < DEPTH:
            if tree.tag[node] in CONTAINERS:
                points.setdefault(node, CONTAINERS[tree.tag[node]])
                points[node] += worth / (1 if level == 0 else 2 if level == 1 else 3 * level)
                level += 1
            node = tree.up[node]

    def density(node: int) -> float:
        return links[node] / chars[node] if chars[node] else 0.0

    score = {node: p * (1 - density(node)) for node, p in points.items()}
    best = max(score, key=lambda node: (score[node], -node)) if score else 0
    node = best
    while node > 0:  # the article around the best container is the container
        if tree.tag[node] in CONTENT_TAGS:
            best = node
        node = tree.up[node]

    kept = {best}
    if tree.tag[best] not in CONTENT_TAGS and best > 0:
        near = max(10.0, 0.2 * score.get(best, 0.0))
        for node in range(1, n):
            if tree.up[node] != tree.up[best] or tree.drop[node]:
                continue
            prose = tree.tag[node] == "p" and chars[node] and density(node) < 0.25
            if score.get(node, 0.0) >= near or prose or tree.tag[node] in HEADINGS and node < best:
                kept.add(node)
    inside = [False] * n
    menu = [False] * n
    article = [False] * n
    for node in range(n):
        up = tree.up[node]
        inside[node] = node in kept or up >= 0 and inside[up]
        article[node] = tree.tag[node] in CONTENT_TAGS or up >= 0 and article[up]
        menu[node] = up >= 0 and menu[up] or (
            node not in kept and tree.tag[node] in ("ul", "ol", "table", "div", "section", "dl")
            and chars[node] > 0 and density(node) > 0.6
            and (not article[node] or node in tree.named))  # a list of sources is article text
    return " ".join(t for b, t in texts if inside[b] and not menu[b])


OUT_BYTES = 8 << 20


def extract_pages(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns and ``text`` of every page."""
    ship_package(pages.sparkSession)

    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            at, size, texts = 0, 0, []
            for i in range(batch.num_rows):
                page = column[i].as_py()
                texts.append(main_text(page))
                size += len(page or "")
                if size >= OUT_BYTES or i == batch.num_rows - 1:
                    cols = [batch.column(k).slice(at, i + 1 - at) for k in range(batch.num_columns - 1)]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.string())], names=[*keep, "text"])
                    at, size, texts = i + 1, 0, []

    rows = pages.select(*keep, F.col(html_col))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, text string")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_pages(driver_table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
