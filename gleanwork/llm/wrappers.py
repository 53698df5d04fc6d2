"""HTML extraction by wrappers: union-free expressions inferred from the pages of a host.

A page is a sequence of elements and text slots, nested. Inference folds neighbouring equal parts
of a page into repeated groups, then aligns it with what it knows of the host: parts both have are
merged, parts only one has become optional, a longer run of a group makes it repeated, and texts
that differ become a slot. No alternatives are kept, so an expression stays about as large as one
page's template. Pages are folded where they are read, and the expressions of one host are merged
in levels of bounded groups.

A field of an expression belongs to the main text unless its element, the element's class, or what
the host shows about it (the same text on many pages, a repeated group of links) says otherwise.
Where a page has an article element with text, only fields inside it count for that page.
"""

from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.tokens import slices
from gleanwork.llm.url_filters import host_of
from gleanwork.session import materialize

# Element names by what they mean to this operator.
RAW = {"script", "style", "textarea", "title", "noscript", "xmp", "template", "iframe", "noembed", "noframes"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = set(
    "head script style noscript template svg math iframe object canvas audio video map nav header footer aside form "
    "button select option textarea input fieldset menu dialog title noembed noframes xmp datalist".split()
)
# Elements whose end an element of the second column implies.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
# An open paragraph ends where one of these begins.
ENDS_PARAGRAPH = set(
    "address article aside blockquote center details dialog dir div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section table ul".split()
)
# An implied end never reaches out of one of these.
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
# Words of a class, id or role that mark menus, notices, adverts, comments and the like.
BOILERPLATE = set(
    "nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer sidebar aside ad ads advert adverts "
    "advertisement banner sponsor sponsored promo cookie cookies consent notice notices gdpr popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended comment comments disqus reply replies "
    "respond pagination pager toolbar widget widgets search hidden copyright legal disclaimer alert skip".split()
)
# Never marked by class words, as the page's text is in them.
PAGE_ELEMENTS = {"html", "body", "main"}
MAIN_ELEMENTS = {"article", "main"}
MAIN_CLASSES = {"article", "post", "entry", "content", "story", "main"}

# The same text on this many different pages, outside an article, is part of the template.
TEMPLATE_PAGES = 3
# A repeated group with at least this share of its text in links is a menu.
LINK_SHARE = 0.8
# Expressions merged by one task at a time.
MERGE = 64

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/><]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
BLANK = re.compile(r"\s+")
BOUND = re.compile("[>\"']")
# Elements below this depth that neither are marked nor hold main text are read as part of the one above;
# nodes end, with all inside them, this many levels further down.
LEVELS_DEEP = 200
LEVELS_MORE = 50
TAG_NAME = re.compile(r"</?[A-Za-z][^\s/><]*")
# Ends a label that class words alone mark, until the page is read.
MAYBE = "\0"
# A folded sequence with more items is no template; its items are taken as optional, in any order.
LONGEST_SEQUENCE = 120


def _label(name: str, attributes: str) -> tuple[str, bool]:
    """Label of an element: its name and the words of its class, id and role; and whether it is marked."""
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
    words = [w.lower() for k in ("class", "id", "role") for w in re.split(r"[^A-Za-z0-9]+", found.get(k, "")) if w]
    unseen = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
    unseen = unseen or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.IGNORECASE))
    marked = unseen or name in DROPPED
    maybe = not marked and name not in PAGE_ELEMENTS and bool(BOILERPLATE.intersection(words))
    # Numbers differ from page to page; they would tear a host's template apart.
    kind = ".".join([name, *(w for w in words if not any(c.isdigit() for c in w))])
    return kind + ("!" if marked else MAYBE if maybe else ""), marked or maybe


# The pages of a host repeat their elements; labels of the last 4,096 with short attributes are kept.
KEPT_ATTRIBUTES = 200
_known_label = lru_cache(maxsize=4_096)(_label)


def parse(page: str | None) -> list:
    """A page as nested nodes: [label, children] for elements, [text, characters in links] for text.

    Inline elements only add their text to the block they are in; ``br`` is a blank. Elements left
    open end with what contains them; a ``<`` whose tag never ends is text. Time grows with the
    length of the page, whatever is left open in it.
    """
    page = page or ""
    root: list = ["", []]
    stack = _Stack(root)
    tags = _Tags(page)
    text: list[str] = []
    links = linked = at = 0

    def flush() -> None:
        nonlocal text, linked
        joined = BLANK.sub(" ", entities.unescape("".join(text))).strip()
        if joined:
            stack.node[1].append((joined, linked))
        text, linked = [], 0

    def add(piece: str) -> None:
        nonlocal linked
        text.append(piece)
        if links:
            linked += len(piece.strip())

    while at < len(page):
        # Nearly always the next "<" begins a tag.
        m = TOKEN.match(page, start) if tags.ends is None and (start := page.find("<", at)) >= 0 else None
        m = m or tags.search(at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name == "br":
            add(" ")
        elif name in RAW and not closing:
            flush()
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif name in INLINE:
            if name == "a":
                links = 0 if closing else 1
            elif not closing and _label(name, m[3])[1]:
                # A marked inline element is a block of its own, so that it can be left out.
                flush()
                stack.open(name, m[3])
            elif closing and stack.name == name:
                flush()
                stack.close(stack.nearest(name))
        elif name in VOID:
            if name != "wbr":
                flush()
        elif closing:
            if depth := stack.nearest(name):
                flush()
                stack.close(depth)
                links = 0
            elif name == "p":
                flush()
        else:
            flush()
            if name in ENDS_PARAGRAPH:
                stack.imply({"p"}, {"table", "td", "th", "button"})
            if name in CLOSES:
                stack.imply(CLOSES[name], SCOPES[name])
            stack.open(name, m[3])
    flush()
    return _settled(root[1])


def _settled(nodes: list) -> list:
    """The nodes with every mark by class words kept (``!``) or lifted.

    It is lifted from articles and from what holds an article or main element with text. Inside an
    article all are kept: articles there are comments on it. What holds a main element by class
    only, as notices do too, is lifted if such text is more than all the page has otherwise.
    """
    _lift(nodes, lambda label: label.split(".")[0] in MAIN_ELEMENTS)
    if _buried(nodes) > _size(nodes):
        _lift(nodes, _is_main)
    return _kept(nodes)


def _lift(nodes: list, is_main: Callable[[str], bool]) -> None:
    for node in nodes:
        label, inside = node
        if not isinstance(inside, list) or label.endswith("!"):
            continue
        article = label.rstrip(MAYBE).split(".")[0] == "article"
        if article:
            node[0] = label.rstrip(MAYBE)
        else:
            _lift(inside, is_main)
            if label.endswith(MAYBE) and _has_main(inside, is_main):
                node[0] = label.rstrip(MAYBE)


def _buried(nodes: list, under: bool = False) -> int:
    """Characters in main elements inside elements that class words alone mark."""
    total = 0
    for label, inside in nodes:
        if isinstance(inside, list) and not label.endswith("!"):
            found = under and _is_main(label)
            total += _size(inside) if found else _buried(inside, under or label.endswith(MAYBE))
    return total


def _kept(nodes: list) -> list:
    for node in nodes:
        if isinstance(node[1], list):
            if node[0].endswith(MAYBE):
                node[0] = node[0].rstrip(MAYBE) + "!"
            _kept(node[1])
    return nodes


class _Tags:
    """The tags of a page, in linear time however many of them are never closed."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.ends: tuple[list[int], list[int]] | None = None

    def search(self, at: int) -> re.Match | None:
        """The first tag or comment from ``at`` on; a ``<`` whose tag has no end is text."""
        while (at := self.page.find("<", at)) >= 0:
            if self.ends is None or self._closes(at):
                if m := TOKEN.match(self.page, at):
                    return m
                if self.ends is None and self.page[at + 1 : at + 2].isalpha():
                    self.ends = self._ends()
            at += 1
        return None

    def _closes(self, at: int) -> bool:
        m = TAG_NAME.match(self.page, at)
        if not m:
            return True
        places, ends = self.ends
        k = bisect_left(places, m.end())
        return k < len(places) and ends[k] >= 0

    def _ends(self) -> tuple[list[int], list[int]]:
        """Places of ``>`` and of quotes, and where a tag ends that is read on from there (-1: nowhere)."""
        places = [m.start() for m in BOUND.finditer(self.page)]
        ends = [-1] * (len(places) + 1)
        later = {}
        for k in range(len(places) - 1, -1, -1):
            sign = self.page[places[k]]
            if sign == ">":
                ends[k] = places[k]
            else:
                if sign in later:
                    ends[k] = ends[later[sign] + 1]
                later[sign] = k
        return places, ends


class _Stack:
    """Open elements, with the depths at which each name is open, so that no step walks the stack."""

    def __init__(self, root: list) -> None:
        self.open_elements: list[tuple[str, list, int]] = [("", root, 0)]
        self.depths: dict[str, list[int]] = defaultdict(list)

    @property
    def name(self) -> str:
        return self.open_elements[-1][0]

    @property
    def node(self) -> list:
        """The node that what comes next belongs to."""
        return self.open_elements[-1][1]

    def nearest(self, *names: str) -> int:
        """Depth of the innermost open element of these names, 0 if there is none."""
        depth = 0
        for name in names:
            at = self.depths[name]
            if at and at[-1] > depth:
                depth = at[-1]
        return depth

    def open(self, name: str, attributes: str) -> None:
        label, marked = (_known_label if len(attributes) <= KEPT_ATTRIBUTES else _label)(name, attributes)
        node, level = self.open_elements[-1][1:]
        if level < LEVELS_DEEP or (level < LEVELS_DEEP + LEVELS_MORE and (marked or _is_main(label))):
            inner: list = [label, []]
            node[1].append(inner)
            node, level = inner, level + 1
        self.depths[name].append(len(self.open_elements))
        self.open_elements.append((name, node, level))

    def close(self, depth: int) -> None:
        """End the element at ``depth`` and all inside it."""
        while len(self.open_elements) > depth:
            self.depths[self.open_elements.pop()[0]].pop()

    def imply(self, names: set[str], scope: set[str]) -> None:
        """End the nearest open element of ``names`` and all inside it, unless ``scope`` lies between."""
        depth = self.nearest(*names)
        if depth and depth > self.nearest(*scope):
            self.close(depth)


# An item of an expression: {"t": label ("#" for text), "q": "1", "?", "+" or "*", "c": items inside,
# "k": hash of a text that never differed, else None, "p": hashes of TEMPLATE_PAGES different pages with
# that text at most, "s": characters, "l": in links}.


def texts_of(nodes: list) -> Iterator[str]:
    """The texts outside marked elements; pages that have the same are copies."""
    for label, inside in nodes:
        if not isinstance(inside, list):
            yield label
        elif not label.endswith("!"):
            yield from texts_of(inside)


def induce(nodes: list, page: str | None = None) -> list[dict]:
    """The expression of one page: its nodes with neighbouring equal parts folded."""
    page = page or xxhash.xxh64_hexdigest("\n".join(texts_of(nodes)).encode())
    items = []
    for label, inside in nodes:
        if isinstance(inside, list):
            own = induce(inside, page)
            items.append(
                {"t": label, "q": "1", "c": own, "k": None, "p": [], "s": sum(i["s"] for i in own), "l": sum(i["l"] for i in own)}
            )
        else:
            key = xxhash.xxh64_hexdigest(label.encode())
            items.append({"t": "#", "q": "1", "c": [], "k": key, "p": [page], "s": len(label), "l": min(inside, len(label))})
    return fold(items)


def fold(items: list[dict]) -> list[dict]:
    """Neighbouring runs of equal labels become repeated groups; groups of up to three labels are found."""
    for width in (1, 2, 3):
        out: list[dict] = []
        at = 0
        while at < len(items):
            unit = items[at : at + width]
            labels = [i["t"] for i in unit]
            end = at + width
            merged = unit
            while len(labels) == width and [i["t"] for i in items[end : end + width]] == labels:
                merged = [_merge(a, b) for a, b in zip(merged, items[end : end + width])]
                end += width
            if end > at + width and (width == 1 or len(set(labels)) > 1):
                if width == 1:
                    merged[0]["q"] = "*" if merged[0]["q"] in "?*" else "+"
                    out += merged
                else:
                    sums = {k: sum(i[k] for i in merged) for k in ("s", "l")}
                    out.append({"t": "(" + " ".join(labels) + ")", "q": "+", "c": merged, "k": None, "p": [], **sums})
                at = end
            else:
                out.append(items[at])
                at += 1
        items = out
    return _squashed(items) if len(items) > LONGEST_SEQUENCE else items


def _squashed(items: list[dict]) -> list[dict]:
    """A sequence without a template: one optional item per label, in order of appearance.

    It is repeated if one of its items was, not for standing in several places: a menu is a run.
    """
    by_label: dict[str, dict] = {}
    for item in items:
        by_label[item["t"]] = _merge(by_label[item["t"]], item) if item["t"] in by_label else item
    return [_optional(item) for item in by_label.values()]


def _merge(a: dict, b: dict) -> dict:
    """One item for two of the same label."""
    key = a["k"] if a["k"] == b["k"] else None
    many, maybe = a["q"] in "+*" or b["q"] in "+*", a["q"] in "?*" or b["q"] in "?*"
    return {
        "t": a["t"],
        "q": "*" if many and maybe else "+" if many else "?" if maybe else "1",
        "c": align(a["c"], b["c"]),
        "k": key,
        "p": sorted({*a["p"], *b["p"]})[:TEMPLATE_PAGES] if key else [],
        "s": a["s"] + b["s"],
        "l": a["l"] + b["l"],
    }


def _optional(item: dict) -> dict:
    return {**item, "q": {"1": "?", "+": "*"}.get(item["q"], item["q"])}


def align(a: list[dict], b: list[dict]) -> list[dict]:
    """One sequence for two: the longest common subsequence of labels is merged, the rest is optional."""
    if [i["t"] for i in a] == [i["t"] for i in b]:
        return [_merge(x, y) for x, y in zip(a, b)]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i]["t"] == b[j]["t"] else max(best[i + 1][j], best[i][j + 1])
    out: list[dict] = []
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and a[i]["t"] == b[j]["t"]:
            item = _merge(a[i], b[j])
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            item, i = _optional(a[i]), i + 1
        else:
            item, j = _optional(b[j]), j + 1
        if out and out[-1]["t"] == item["t"]:
            # Optional neighbours of one label are a repeated group.
            joined = _merge(out[-1], item)
            joined["q"] = "*" if out[-1]["q"] in "?*" and item["q"] in "?*" else "+"
            out[-1] = joined
        else:
            out.append(item)
    return _squashed(out) if len(out) > LONGEST_SEQUENCE else out


def decide(wrapper: list[dict]) -> list[dict]:
    """Mark each item ``x`` (left out) or not, from labels and what the host's pages show."""

    def walk(items: list[dict], inside: bool) -> list[dict]:
        out = []
        for i in items:
            main = inside or _is_main(i["t"])
            fixed = i["t"] == "#" and i["k"] is not None and len(i["p"]) >= TEMPLATE_PAGES and not main
            menu = i["q"] in "+*" and i["s"] > 0 and i["l"] >= LINK_SHARE * i["s"] and not main
            out.append({"t": i["t"], "x": i["t"].endswith("!") or fixed or menu, "c": walk(i["c"], main)})
        return out

    return walk(wrapper, False)


def _is_main(label: str) -> bool:
    if label.endswith(MAYBE):
        return False
    name, *words = label.rstrip("!").split(".")
    return name in MAIN_ELEMENTS or (name in ("div", "section") and bool(MAIN_CLASSES.intersection(words)))


def _size(nodes: list) -> int:
    """Characters of text outside marked elements."""
    return sum(len(n[0]) if not isinstance(n[1], list) else 0 if _marked(n[0]) else _size(n[1]) for n in nodes)


def _marked(label: str) -> bool:
    return label.endswith(("!", MAYBE))


def _has_main(nodes: list, is_main: Callable[[str], bool] = _is_main) -> bool:
    """Whether there is an unmarked main element with unmarked text."""
    return any(
        isinstance(inside, list) and not _marked(label) and (is_main(label) and _size(inside) > 0 or _has_main(inside, is_main))
        for label, inside in nodes
    )


def _sure_main(nodes: list) -> bool:
    """Whether main elements outside of boxes with class words have text, or those inside hold most of the page's."""

    def sizes(own: list, boxed: bool) -> tuple[int, int]:
        sure = boxes = 0
        for label, inside in own:
            if isinstance(inside, list) and not _marked(label):
                if _is_main(label):
                    a, b = (0, _size(inside)) if boxed else (_size(inside), 0)
                else:
                    name, *words = label.split(".")
                    a, b = sizes(inside, boxed or name not in PAGE_ELEMENTS and bool(BOILERPLATE.intersection(words)))
                sure, boxes = sure + a, boxes + b
        return sure, boxes

    sure, boxes = sizes(nodes, False)
    return sure > 0 or 2 * boxes > _size(nodes)


def extract(page: str | None, wrapper: list[dict] | None) -> list[str]:
    """The page's main blocks in order, as the wrapper's fields say.

    Without a wrapper, or where a page leaves it, labels alone decide. On a page with a main
    element, text outside of it is left out; other pages of the host keep theirs.
    """
    nodes = parse(page)
    only_main = _sure_main(nodes)
    if wrapper is None:
        wrapper = decide(induce(nodes))
    out: list[str] = []

    def walk(own: list, items: list[dict], main: bool) -> None:
        # Items of repeated groups stand for their labels in turn.
        flat = [x for i in items for x in (i["c"] if i["t"].startswith("(") else [i])]
        at = 0
        for label, inside in own:
            kind = label if isinstance(inside, list) else "#"
            order = [*range(at, len(flat)), *range(0, at)]
            place = next((k for k in order if flat[k]["t"] == kind), None)
            item = flat[place] if place is not None else None
            at = place if place is not None else at
            left_out = item["x"] if item else kind.endswith("!")
            if left_out:
                continue
            if isinstance(inside, list):
                walk(inside, item["c"] if item else [], main or _is_main(label))
            elif main or not only_main:
                out.append(label)

    walk(nodes, wrapper, False)
    return out


def _join(expressions: list[str]) -> str:
    done: list[dict] | None = None
    for raw in expressions:
        own = json.loads(raw)
        done = own if done is None else align(done, own)
    return json.dumps(done or [], separators=(",", ":"))


def _induced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, expression) of the pages of each batch, merged by host."""
    for batch in slices(batches, 1_000):
        by_host: dict[str, list[dict]] = {}
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            own = induce(parse(page))
            by_host[host] = align(by_host[host], own) if host in by_host else own
        rows = [json.dumps(w, separators=(",", ":")) for w in by_host.values()]
        yield pa.record_batch({"host": pa.array(list(by_host), pa.string()), "wrapper": pa.array(rows, pa.string())})


def _merged(group: pa.Table) -> pa.Table:
    rows = sorted(group.column("wrapper").to_pylist())
    return pa.table({"host": group.column("host").slice(0, 1).combine_chunks(), "wrapper": pa.array([_join(rows)], pa.string())})


def infer(pages: DataFrame) -> DataFrame:
    """(host, wrapper) for pages (host, html): merged in levels, ``MERGE`` expressions a task at most, about."""
    parts = materialize(pages.select("host", "html").mapInArrow(_induced, "host string, wrapper string"))
    while True:
        sizes = parts.groupBy("host").agg(F.count("*").alias("n"))
        most = sizes.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return parts
        salts = F.ceil(F.col("n") / MERGE)
        dealt = parts.join(sizes, "host").withColumn("salt", F.pmod(F.xxhash64("wrapper"), salts))
        parts = materialize(
            dealt.select("host", "salt", "wrapper").groupBy("host", "salt").applyInArrow(_merged, "host string, wrapper string")
        )
        if most <= MERGE:
            return parts


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and blocks (array of strings) of every page.

    Defined results: a null page is empty and has no blocks; a null or malformed address belongs
    to the host ``""``; repeated rows are all returned; an empty table gives no rows. Unclosed
    elements end with what contains them; white space inside a block is one blank.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(host_of(F.col(url).cast("string")), F.lit("")).alias("host"),
        F.col(html).cast("string").alias("html"),
    )
    wrappers = infer(rows)
    joined = rows.join(wrappers, "host")
    return joined.mapInArrow(
        _extracted,
        f"page_id {rows.schema['page_id'].dataType.simpleString()}, url {rows.schema['url'].dataType.simpleString()}, "
        "text string, blocks array<string>",
    )


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, list[dict]] = {}
    for batch in slices(batches, 1_000):
        blocks = []
        hosts, raw = batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()
        for host, wrapper, page in zip(hosts, raw, batch.column("html").to_pylist()):
            if host not in known:
                if len(known) >= 256:
                    known.clear()
                known[host] = decide(json.loads(wrapper))
            blocks.append(extract(page, known[host]))
        yield pa.record_batch(
            {
                "page_id": batch.column("page_id"),
                "url": batch.column("url"),
                "text": pa.array([" ".join(b) for b in blocks], pa.string()),
                "blocks": pa.array(blocks, pa.list_(pa.string())),
            }
        )
