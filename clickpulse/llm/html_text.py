"""Main text of web pages by wrapper induction.

Pages of one host are aligned by simple tree matching of their DOM trees.
Trees are compared with repeated siblings folded (a list of paragraphs is one
slot), so alignment runs once per distinct tree shape of a host, not per page.
A text block that nearly all distinct pages of the host have in one slot is
template, whatever else is in the slot; blocks that vary are content. What HTML itself marks as furniture
(navigation, header, footer, aside, form, script, hidden elements ...) is content
on no page. Words of class and id attributes (advert, notice, comment ...) are
hints: they mark no element that is or holds the main text, and what they mark
is used, less the template, where nothing else on a page varies.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import materialize, shielded, without

#: A block is template if at least this many distinct pages of the host have its
#: slot and this share of them have its text there.
MIN_PAGES = 4
SAME_SHARE = 0.9
#: The template nodes are sent to every task up to this size.
BROADCAST_BYTES = 64 << 20

# fixed values: HTML element names by role, and words of class, id and role
# attributes that mark furniture
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split())
FURNITURE = frozenset(
    "head nav header footer aside form menu script style noscript template iframe svg canvas object audio video "
    "button select textarea input label fieldset dialog title noembed noframes xmp".split())
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar alert alertdialog dialog tablist "
    "toolbar status".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion "
    "banner sidebar menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login comment comments reply replies respond disqus social share sharing related "
    "recommended widget widgets search pagination pager toolbar copyright disclaimer form".split())
MAIN_ROLES = frozenset(["main", "article"])
CLOSES = {      # an opening tag ends the open elements of these names, up to a limit
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>", re.S)
_OPEN_MARK = re.compile(r"<[!?]")            # after the last ">" it takes the rest
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in RAW}


class Page:
    """Folded DOM of a page and its text blocks.

    ``nodes`` holds (parent, signature, depth); siblings with one signature
    are one node. ``blocks`` holds (node, text, region, hinted) of every block
    that is not furniture, in page order: ``region`` is the number of the main
    region it is in or 0, ``hinted`` whether a class or id word marks it there.
    ``regions`` holds (is ``main``, inside a marked element) of each region.
    """

    def __init__(self, source: str):
        self.nodes: list[tuple[int, str, int]] = [(-1, "#", 0)]
        self._known: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str, int, bool]] = []
        self.regions: list[tuple[bool, bool]] = [(False, False)]
        # texts of the block, pieces inside and outside of links: not hinted, hinted
        self._text: tuple[list[str], list[str]] = ([], [])
        self._linked, self._plain = [0, 0], [0, 0]
        # open elements: (tag, node, furniture, main region, block node, in link, hinted, in a form outside of main)
        self._stack = [("#", 0, False, 0, 0, False, False, False)]
        self._read(source)

    # -- building ------------------------------------------------------
    def _read(self, source: str) -> None:
        # no tag can end after the last ">": a search beyond it would read the rest for every "<" in vain
        pos, token, last = 0, _TOKEN, source.rfind(">") + 1
        while pos < last and (m := token.search(source, pos, last)):
            if m.start() > pos:
                self._add(source[pos:m.start()])
            pos = m.end()
            name = m.group(2)
            if name is None:
                if pos == last and m.group().startswith("<!--") and not m.group().endswith("-->"):
                    pos = len(source)               # an open comment takes the rest
                continue
            name = name.lower()
            if m.group(1):
                self._close(name)
                continue
            self._open(name, m.group(3))
            if name in RAW:
                end = _RAW_END[name].search(source, pos)
                self._close(name)
                pos = end.end() if end else len(source)
        rest = source[pos:]
        mark = _OPEN_MARK.search(rest)
        self._add(rest[:mark.start()] if mark else rest)
        self._flush()

    def _add(self, text: str) -> None:
        top = self._stack[-1]
        if top[2] or top[7]:
            return
        self._text[top[6]].append(html.unescape(text) if "&" in text else text)
        if text.strip():
            (self._linked if top[5] else self._plain)[top[6]] += 1

    def _flush(self) -> None:
        for hinted, pieces in enumerate(self._text):
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    top = self._stack[-1]
                    # a list item that is nothing but links is a menu, outside the main region
                    menu = self._linked[hinted] and not self._plain[hinted] and not top[3] and any(
                        s[0] in ("ul", "ol") for s in self._stack)
                    if not menu:
                        self.blocks.append((top[4], text, top[3], bool(hinted)))
                pieces.clear()
            self._linked[hinted] = self._plain[hinted] = 0

    def _open(self, name: str, attrs: str) -> None:
        if name == "br":
            for pieces in self._text:
                pieces.append(" ")
            return
        block = name in BLOCK
        if block:
            self._flush()
            if name != "option" and any(s[0] == "p" for s in self._stack[-6:]):
                self._close("p")
        if name in CLOSES:
            shut, limit = CLOSES[name]
            for k in range(len(self._stack) - 1, 0, -1):
                if self._stack[k][0] in shut:
                    del self._stack[k:]
                    break
                if self._stack[k][0] in limit:
                    break
        if name in VOID:
            return
        tag, node, furniture, region, block_node, link, hinted, form = self._stack[-1]
        sign, marked, hint, is_main = self._describe(name, attrs)
        key = (node, sign)
        child = self._known.get(key)
        if child is None:
            child = self._known[key] = len(self.nodes)
            self.nodes.append((node, sign, self.nodes[node][2] + 1))
        if marked and name == "form" and not region:
            form = True
        else:
            furniture = furniture or marked
        if is_main and not region and not furniture:
            region = len(self.regions)
            self.regions.append((sign.startswith("main"), hinted or form))
            hinted = form = False           # what holds the main text is not furniture
        elif hint and not is_main:
            hinted = True
        self._stack.append((name, child, furniture, region, child if block else block_node, link or name == "a",
                            hinted, form))

    def _close(self, name: str) -> None:
        block = name in BLOCK
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k][0] == name:
                if block:
                    self._flush()
                del self._stack[k:]
                return
            if not block and self._stack[k][0] in BLOCK:
                return          # an inline end tag does not end a block

    @staticmethod
    def _describe(name: str, attrs: str) -> tuple[str, bool, bool, bool]:
        """Signature, whether the element is furniture, whether its words hint at it, whether it is the main text."""
        marked, hint, is_main, sign, seen = name in FURNITURE, False, name in ("article", "main"), name, set()
        if attrs and not attrs.isspace():
            for key, a, b, c in _ATTR.findall(attrs):
                key, value = key.lower(), (a or b or c).lower()
                if key in seen:             # the first of a name counts
                    continue
                seen.add(key)
                if key == "role":
                    marked = marked or value in FURNITURE_ROLES
                    is_main = is_main or value in MAIN_ROLES
                elif key in ("class", "id"):
                    found = _NAME.findall(value)
                    sign += "." + "-".join(found)
                    if name not in ("html", "body", "main") and not (len(name) == 2 and name[0] == "h"):
                        hint = hint or not FURNITURE_WORDS.isdisjoint(found)
                elif key == "hidden" or key == "aria-hidden" and value == "true" \
                        or key == "style" and "display:none" in value.replace(" ", ""):
                    marked = True
        return sign, marked, hint, is_main

    # -- reading -------------------------------------------------------
    def candidates(self) -> list[tuple[int, str, bool]]:
        """(node, text, hinted) of the blocks of the main region, or of all blocks where a page marks none.

        A main region inside marked elements counts if the page has no other.
        It is taken alone if it is the only one, or ``main``, and outweighs
        the unmarked text around it; else both are taken, as articles in a
        marked element may be comments on unmarked text.
        """
        clean = {k for k, (_, inside) in enumerate(self.regions) if k and not inside}
        within = {k for _, _, k, _ in self.blocks if k and k not in clean}
        use = clean
        if not any(k in clean for _, _, k, _ in self.blocks) and within:
            inner = sum(len(t) for _, t, k, hinted in self.blocks if k in within and not hinted)
            outer = sum(len(t) for _, t, k, hinted in self.blocks if not k and not hinted)
            mains = {k for k in within if self.regions[k][0]}
            use = mains or within
            if inner < outer and not clean or not mains and len(within) > 1:
                return [(n, t, hinted) for n, t, _, hinted in self.blocks]
        return [(n, t, hinted) for n, t, k, hinted in self.blocks if k in use or not use]

    def kept(self) -> list[tuple[int, str]]:
        """The candidates that are not hinted, or all of them if there are no others."""
        found = self.candidates()
        return [(n, t) for n, t, hinted in found if not hinted] or [(n, t) for n, t, _ in found]

    def shape(self) -> str:
        return json.dumps([(p, s) for p, s, _ in self.nodes], separators=(",", ":"))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42) - (1 << 63)


def _depths(nodes: list) -> list[int]:
    out: list[int] = []
    for p, _ in nodes:
        out.append(0 if p < 0 else out[p] + 1)
    return out


def match_trees(a: list, b: list) -> dict[int, int]:
    """Simple tree matching: nodes of ``a`` mapped to nodes of ``b``, as many as possible.

    Trees are lists of (parent, signature) with parents first. Two nodes match
    only if their signatures are equal and their parents match; the order of
    children is kept.
    """
    kids_a: list[list[int]] = [[] for _ in a]
    kids_b: list[list[int]] = [[] for _ in b]
    for kids, tree in ((kids_a, a), (kids_b, b)):
        for i, (p, _) in enumerate(tree):
            if p >= 0:
                kids[p].append(i)
    at: dict[tuple[int, str], list[int]] = {}
    for j, d in enumerate(_depths(b)):
        at.setdefault((d, b[j][1]), []).append(j)
    size: dict[tuple[int, int], int] = {}
    tables: dict[tuple[int, int], list[list[int]]] = {}
    depth_a = _depths(a)
    for i in range(len(a) - 1, -1, -1):             # children come after parents
        for j in at.get((depth_a[i], a[i][1]), ()):
            ka, kb = kids_a[i], kids_b[j]
            m = [[0] * (len(kb) + 1) for _ in range(len(ka) + 1)]
            for x, ca in enumerate(ka, 1):
                for y, cb in enumerate(kb, 1):
                    m[x][y] = max(m[x - 1][y], m[x][y - 1], m[x - 1][y - 1] + size.get((ca, cb), 0))
            size[i, j] = 1 + m[-1][-1]
            tables[i, j] = m
    found, todo = {}, [(0, 0)] if (0, 0) in size else []
    while todo:
        i, j = todo.pop()
        found[i] = j
        m, x, y = tables[i, j], len(kids_a[i]), len(kids_b[j])
        while x and y:
            pair = (kids_a[i][x - 1], kids_b[j][y - 1])
            if pair in size and m[x][y] == m[x - 1][y - 1] + size[pair]:
                todo.append(pair)
                x, y = x - 1, y - 1
            elif m[x][y] == m[x - 1][y]:
                x -= 1
            else:
                y -= 1
    return found


# -------------------------------------------------------------------- Spark

_SURVEY_TYPE = "struct<shape:string,content:bigint,slots:array<struct<node:int,text:bigint>>>"
_ALIGNED_TYPE = "array<int>"
_BLOCKS_TYPE = "struct<shape_hash:bigint,blocks:array<struct<node:int,text:string,hash:bigint,hinted:boolean>>>"

def _survey(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Tree shape, hash of the candidate text, and the distinct text hashes of each slot of each page."""
    for batch in pages:
        shapes, contents, slots = [], [], []
        for source in batch:
            page = Page(source.as_py() or "")
            found = page.candidates()
            shapes.append(page.shape())
            contents.append(_hash(" ".join(t for _, t, _ in found)))
            slots.append([{"node": n, "text": h} for n, h in sorted({(n, _hash(t)) for n, t, _ in found})])
        yield pa.StructArray.from_arrays(
            [pa.array(shapes, pa.string()), pa.array(contents, pa.int64()),
             pa.array(slots, pa.list_(pa.struct([("node", pa.int32()), ("text", pa.int64())])))],
            ["shape", "content", "slots"])


def _aligned(shapes: pa.Array, seeds: pa.Array) -> pa.Array:
    """For every node of a shape its node of the host's seed, or -1."""
    out = []
    for a, b in zip(shapes.to_pylist(), seeds.to_pylist()):
        tree = [tuple(x) for x in json.loads(a)]
        found = match_trees(tree, [tuple(x) for x in json.loads(b)])
        out.append([found.get(i, -1) for i in range(len(tree))])
    return pa.array(out, pa.list_(pa.int32()))


def _blocks(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in pages:
        shapes, blocks = [], []
        for source in batch:
            page = Page(source.as_py() or "")
            shapes.append(_hash(page.shape()))
            blocks.append([{"node": n, "text": t, "hash": _hash(t), "hinted": h} for n, t, h in page.candidates()])
        yield pa.StructArray.from_arrays(
            [pa.array(shapes, pa.int64()),
             pa.array(blocks, pa.list_(pa.struct([("node", pa.int32()), ("text", pa.string()), ("hash", pa.int64()),
                                                  ("hinted", pa.bool_())])))],
            ["shape_hash", "blocks"])


def _shape_hash(shapes: pa.Array) -> pa.Array:
    return pa.array([_hash(s) for s in shapes.to_pylist()], pa.int64())


def induce_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, shape_hash, template): the template blocks (node, text hash) of every tree shape of every host.

    The seed of a host is its most frequent shape among pages of distinct
    text. Only shapes and hashes are shuffled, pre-aggregated per task; copies
    of a page count once, so a copied article is not taken for a template.
    """
    survey, aligned = F.arrow_udf(_survey, _SURVEY_TYPE), F.arrow_udf(_aligned, _ALIGNED_TYPE)
    shape_hash = F.arrow_udf(_shape_hash, "bigint")
    host = F.lower(F.try_parse_url(F.col(url_col), F.lit("HOST")))
    surveyed = (pages.select(host.alias("host"), survey(F.coalesce(F.col(html_col), F.lit(""))).alias("s"))
                .where("host IS NOT NULL AND size(s.slots) > 0").select("host", "s.*"))
    distinct = materialize(surveyed.groupBy("host", "content").agg(
        F.min(F.struct("shape", "slots")).alias("p")).select("host", "p.*"), "wrappers")
    shapes = distinct.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"))
    seeds = shapes.groupBy("host").agg(F.max_by("shape", F.struct("n", "shape")).alias("seed"))
    mapped = shapes.join(seeds, "host").select("host", "shape", aligned("shape", "seed").alias("to"))
    met = distinct.join(mapped, ["host", "shape"])
    slots = (met.select("host", F.explode("slots").alias("slot"), "to")
             .select("host", F.expr("to[slot.node]").alias("node"), F.col("slot.text").alias("text"))
             .where("node >= 0").groupBy("host", "node", "text").agg(F.count(F.lit(1)).alias("n")))
    pages_of = (met.select("host", F.explode(F.array_distinct(F.expr(
        "transform(slots, s -> to[s.node])"))).alias("node")).where("node >= 0")
        .groupBy("host", "node").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= MIN_PAGES))
    constant = (slots.where(F.col("n") >= MIN_PAGES * SAME_SHARE).join(pages_of, ["host", "node"])
                .where(F.col("n") >= F.col("pages") * SAME_SHARE).select("host", "node", "text"))
    nodes = mapped.select("host", "shape", F.posexplode("to").alias("own", "node")).where("node >= 0")
    return (nodes.join(constant, ["host", "node"]).groupBy("host", "shape")
            .agg(F.sort_array(F.collect_list(F.struct(F.col("own").alias("node"), F.col("text").alias("hash"))))
                 .alias("template"))
            .select("host", shape_hash("shape").alias("shape_hash"), "template"))


@shielded
def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every row of ``pages`` plus ``text`` (empty if none) and ``n_chars`` (its code points).

    Blocks are joined in page order by one space, white space inside a block
    is one space, character references are decoded once. Defined edge cases:
    null or empty html gives the empty text; a null or host-less url gets no
    wrapper (HTML's own marks still count); blocks that a class or id word marks
    are text only where no other block varies; a page whose every block is
    template is a copy and keeps its text; unclosed elements end where HTML
    ends them; repeated rows are answered each; an empty table gives an empty
    result; input columns named like an output column are replaced.
    """
    pages = without(pages, "text", "n_chars")
    cols = [F.col(f"p.`{c}`") for c in pages.columns]
    wrappers = materialize(induce_wrappers(pages, url_col, html_col), "templates")
    size = wrappers.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("template")).alias("blocks")).first()
    if 100 * size.rows + 32 * (size.blocks or 0) <= BROADCAST_BYTES:
        wrappers = F.broadcast(wrappers)        # else the blocks are shuffled to meet them
    read = pages.withColumn("__host", F.lower(F.try_parse_url(F.col(url_col), F.lit("HOST")))) \
        .withColumn("__b", F.arrow_udf(_blocks, _BLOCKS_TYPE)(F.coalesce(F.col(html_col), F.lit(""))))
    met = read.alias("p").join(wrappers.alias("w"), (F.col("p.__host") == F.col("w.host"))
                               & (F.col("p.__b.shape_hash") == F.col("w.shape_hash")), "left")
    join = lambda blocks: F.array_join(F.transform(blocks, lambda b: b["text"]), " ")
    every = F.col("p.__b.blocks")
    plain = F.filter(every, lambda b: ~b["hinted"])
    varying = F.filter(every, lambda b: ~F.array_contains(
        F.col("w.template"), F.struct(b["node"].alias("node"), b["hash"].alias("hash"))))
    varying = F.when(F.col("w.template").isNotNull(), varying)
    text = (F.when(F.exists(varying, lambda b: ~b["hinted"]), join(F.filter(varying, lambda b: ~b["hinted"])))
            .when(F.size(varying) > 0, join(varying)).when(F.size(plain) > 0, join(plain)).otherwise(join(every)))
    return met.select(*cols, text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
