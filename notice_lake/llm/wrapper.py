"""HTML extraction by wrapper induction: pages of a host are aligned, what stays the same is template."""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notice_lake.llm.common import stored
from notice_lake.llm.url_filter import parts

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL,
)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|([^\s=/"'>]+)""")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style template textarea title iframe object canvas audio video".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: An open element of the values is closed by the start of the key's element.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
#: Elements nested deeper are kept as siblings, as browsers do.
_DEEPEST = 256
_SCOPE = frozenset("ul ol dl table article section main body html div nav aside".split())
#: Elements whose text counts inside of an article only.
_EXTRA = frozenset("svg noscript".split())
#: Elements that make a layout.
_OUTER = frozenset("header nav main article aside section footer form div center table".split())
#: Elements, roles and class or id words that mark what is not content.
_ASIDE_TAGS = frozenset("nav aside footer form button select dialog menu search head header".split())
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar".split())
_ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "cookie cookies consent disqus footer masthead menu modal nav navbar navigation newsletter notice notices "
    "popup promo promoted promotion related replies reply share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar widget widgets".split()
)
#: Those that also name the frame of a layout.
_VAGUE_WORDS = frozenset(
    "banner masthead modal notice notices popup related share sharing sidebar signup social subscribe "
    "subscription toolbar widget widgets".split()
)


@dataclass(frozen=True)
class Wrapper:
    """A text at a place is template if ``pages`` or more have it, and at least ``share`` of the pages with the node around it."""

    share: float = 0.5
    pages: int = 3


@dataclass
class Node:
    tag: str
    aside: bool = False
    main: bool = False
    firm: int = 0
    items: list = field(default_factory=list)  # nodes and texts


def _aside(tag: str, attrs: dict[str, str]) -> bool:
    """Whole class names and ids count, not parts of them."""
    if tag in _ASIDE_TAGS or attrs.get("role", "").lower() in _ASIDE_ROLES or "hidden" in attrs:
        return True
    return not _ASIDE_WORDS.isdisjoint(f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split())


def _firm(tag: str, attrs: dict[str, str]) -> int:
    """How sure it is that an aside is not content: 2 by its element or hidden, 1 by a role or a clear name, 0 for others."""
    if (tag in _ASIDE_TAGS and tag != "form") or "hidden" in attrs:
        return 2
    names = {*f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split()} & _ASIDE_WORDS
    return int(bool(names - _VAGUE_WORDS) or attrs.get("role", "").lower() in _ASIDE_ROLES)


def parse(source: str) -> Node:
    """A tree of elements and texts. Missing end tags are supplied; raw elements are left out."""
    root = Node("html")
    stack, end = [root], 0

    def text(value: str) -> None:
        if value:
            stack[-1].items.append(value)

    at, size = 0, len(source)
    while at < size:
        found = _TOKEN.search(source, at)
        if not found:
            break
        text(source[end : found.start()])
        at = end = found.end()
        if found["cdata"] is not None:
            text(html.escape(found["cdata"], quote=False))
        if not found["tag"]:
            continue
        tag = found["tag"].lower()
        if found["close"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if stack[depth].tag in _BLOCK and tag not in _BLOCK:
                    break
            continue
        if tag in _RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
            at = end = close.end() if close else size
            continue
        if tag in ("html", "body"):
            continue
        closes = _CLOSES.get(tag, ())
        for depth in range(len(stack) - 1, 0, -1):
            name = stack[depth].tag
            if name in closes or (name == "p" and tag in _BLOCK):
                del stack[depth:]
                break
            if name in _SCOPE:
                break
        attrs = {}
        if found["attrs"].strip(" /"):
            attrs = {(a or c).lower(): b.strip("\"'") for a, b, c in _ATTR.findall(found["attrs"])}
        main = tag in ("article", "main") or attrs.get("role", "").lower() in ("main", "article")
        node = Node(tag, _aside(tag, attrs) and not main, main, _firm(tag, attrs))
        stack[-1].items.append(node)
        if tag not in _VOID and not found["attrs"].endswith("/") and len(stack) < _DEEPEST:
            stack.append(node)
    if end < size:
        text(source[end:])
    return root


def _clean(value: str) -> str:
    return " ".join(html.unescape(value).split())


@dataclass
class Skeleton:
    """A tree of block elements without texts; ``number`` counts nodes in page order, parents first.

    Trees with the same ``shape`` are equal, ``size`` counts their nodes.
    """

    tag: str
    number: int
    children: list[Skeleton]
    shape: int
    size: int

    @classmethod
    def read(cls, data: list, count: list[int]) -> Skeleton:
        number = count[0]
        count[0] += 1
        below = [cls.read(c, count) for c in data[1:]]
        return cls(data[0], number, below, hash((data[0], *(c.shape for c in below))), count[0] - number)


def _below(node: Node) -> list[Node]:
    """Block elements of a node; those inside of inline elements count as its own."""
    out: list[Node] = []
    work = node.items[::-1]
    while work:
        item = work.pop()
        if isinstance(item, Node):
            if item.tag in _BLOCK:
                out.append(item)
            else:
                work.extend(reversed(item.items))
    return out


def _frame(node: Node) -> list:
    """Nested tags of the block elements of a node."""
    return [node.tag, *[_frame(c) for c in _below(node)]]


def _numbers(node: Node, numbers: dict[int, int]) -> dict[int, int]:
    """The number of each block element (by ``id``) in the skeleton of the node."""
    numbers[id(node)] = len(numbers)
    for c in _below(node):
        _numbers(c, numbers)
    return numbers


def _ends(x: list[Skeleton], y: list[Skeleton]) -> tuple[int, int]:
    """How many equal trees two lists begin with, and end with. To match these is always best."""
    most = min(len(x), len(y))
    first = last = 0
    while first < most and x[first].shape == y[first].shape:
        first += 1
    while last < most - first and x[-1 - last].shape == y[-1 - last].shape:
        last += 1
    return first, last


def _table(x: list[Skeleton], y: list[Skeleton], memo: dict) -> tuple[int, list]:
    """The largest matching of two lists in order, and the bits that lead back through it."""
    kinds = {b.shape: b for b in y}
    place = {shape: k for k, shape in enumerate(kinds)}
    at = np.array([place[b.shape] for b in y])
    weights: dict[int, np.ndarray] = {}
    above, back = np.zeros(len(y) + 1, np.int64), []
    for a in x:
        if a.shape not in weights:
            weights[a.shape] = np.array([_weight(a, b, memo) for b in kinds.values()])[at]
        row = np.zeros_like(above)
        np.maximum.accumulate(np.maximum(above[1:], above[:-1] + weights[a.shape]), out=row[1:])
        back.append((np.packbits(row == above), np.packbits(row[1:] == row[:-1])))
        above = row
    return int(above[-1]), back


def _weight(a: Skeleton, b: Skeleton, memo: dict) -> int:
    if a.tag != b.tag:
        return 0
    if a.shape == b.shape:
        return a.size
    key = (a.shape, b.shape)
    if key not in memo:
        x, y = a.children, b.children
        first, last = _ends(x, y)
        size = 1 + sum(c.size for c in x[:first]) + sum(c.size for c in x[len(x) - last :])
        x, y = x[first : len(x) - last], y[first : len(y) - last]
        memo[key] = size + (_table(x, y, memo)[0] if x and y else 0)
    return memo[key]


def match(a: Skeleton, b: Skeleton, found: dict[int, int], memo: dict) -> None:
    """Simple tree matching of two trees with the same root tag: which number of ``a`` is which of ``b``."""
    if a.shape == b.shape:
        found.update(zip(range(a.number, a.number + a.size), range(b.number, b.number + b.size)))
        return
    found[a.number] = b.number
    x, y = a.children, b.children
    first, last = _ends(x, y)
    pairs = [*zip(x[:first], y[:first]), *zip(x[len(x) - last :], y[len(y) - last :])]
    x, y = x[first : len(x) - last], y[first : len(y) - last]
    if x and y:
        _, back = _table(x, y, memo)
        bit = lambda bits, k: bits[k >> 3] >> (7 - (k & 7)) & 1
        i, j = len(x), len(y)
        while i and j:
            up, left = back[i - 1]
            if bit(up, j):
                i -= 1
            elif bit(left, j - 1):
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((x[i], y[j]))
    for c, d in pairs:
        match(c, d, found, memo)


def align(node: Node, other: Skeleton, found: dict[int, int]) -> int:
    """Simple tree matching: the size of the largest matching that keeps order and parents.

    Writes to ``found`` which node (by ``id``) is matched with which number of the skeleton.
    """
    if node.tag != other.tag:
        return 0
    pairs: dict[int, int] = {}
    match(Skeleton.read(_frame(node), [0]), other, pairs, {})
    found.update((key, pairs[number]) for key, number in _numbers(node, {}).items() if number in pairs)
    return len(pairs)


@dataclass
class Block:
    text: str
    number: int  # of the block element that it begins in
    inside: bool  # of an article or main
    aside: int  # the innermost aside, or -1


@dataclass
class Aside:
    up: int  # the aside around it, or -1
    content: int  # 2 if it contains a main, 1 if an article
    firm: int


def listed(root: Node, numbers: dict[int, int]) -> tuple[list[Block], list[Aside]]:
    """All blocks of a page in page order, and its asides."""
    out: list[Block] = []
    asides: list[Aside] = []
    run: list[str] = []
    place: list[tuple[int, bool, int]] = []

    def flush() -> None:
        text = _clean("".join(run))
        if text:
            out.append(Block(text, *place[0]))
        run.clear()
        place.clear()

    work: list = [(root, False, 0, -1, None)]
    while work:
        item, inside, number, aside, leave = work.pop()
        if leave is not None:
            flush()
            run.extend(leave[0])
            place.extend(leave[1])
        elif isinstance(item, str):
            if not item.isspace() and not place:
                place.append((number, inside, aside))
            run.append(item)
        elif item.tag == "br":
            run.append(" ")
        else:
            number = numbers.get(id(item), number)
            out_of_place = (item.aside and not (item.tag == "header" and inside)) or (item.tag in _EXTRA and not inside)
            if out_of_place:
                asides.append(Aside(aside, 0, 2 if item.tag in _EXTRA else item.firm))
                aside = len(asides) - 1
            if item.main:
                inside, above, content = True, aside, 1 if item.tag == "article" else 2
                while above >= 0 and asides[above].content < content:
                    asides[above].content = content
                    above = asides[above].up
            if item.tag in _BLOCK:
                flush()
                work.append((item, inside, number, aside, ([], [])))
            elif out_of_place:  # the text around an inline element is one block
                work.append((item, inside, number, aside, (run[:], place[:])))
                run.clear()
                place.clear()
            work.extend((c, inside, number, aside, None) for c in reversed(item.items))
    flush()
    return out, asides


def chosen(found: list[Block], asides: list[Aside], constant: list[bool]) -> list[Block]:
    """The blocks that are content, given which are template.

    Asides go, except: one that contains a main stays, and so does one with an article if no article is outside
    of asides. A form, or what a vague name marks, stays if it holds most of the varying text; what a role
    or a clear name marks stays then if the page has no article.
    If what is left is mostly inside of articles, what is outside goes.
    """
    free, articles = any(b.inside and b.aside < 0 for b in found), any(b.inside for b in found)
    total, held = 0, [0] * len(asides)
    for b, same in zip(found, constant, strict=True):
        if not same:
            total += len(b.text)
            above = b.aside
            while above >= 0:
                held[above] += len(b.text)
                above = asides[above].up
    stays = [True] * (len(asides) + 1)  # the last one is for -1
    for k, a in enumerate(asides):
        most = 2 * held[k] > total and a.firm < 2
        by_content = a.content == 2 or (a.content == 1 and not free)
        stays[k] = stays[a.up] and (by_content or (most and (not a.firm or not articles)))
    kept = [b for b, same in zip(found, constant, strict=True) if not same and stays[b.aside]]
    own = [b for b in kept if b.inside]
    if 2 * sum(len(b.text) for b in own) >= sum(len(b.text) for b in kept):
        return own or kept
    return kept


def blocks(root: Node, numbers: dict[int, int]) -> list[tuple[str, int, bool]]:
    """Content of a page that is looked at alone: text, number of the element, inside of an article."""
    found, asides = listed(root, numbers)
    return [(b.text, b.number, b.inside) for b in chosen(found, asides, [False] * len(found))]


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _layout(node: Node) -> str:
    """A digest of the outer elements of a page: the paths of sections down to three levels, each once."""
    paths: set[str] = set()
    work = [(node, "", 0)]
    while work:
        item, path, depth = work.pop()
        for c in _below(item) if depth < 3 else ():
            if c.tag in _OUTER or c.main:
                paths.add(own := f"{path}/{c.tag}")
                if not c.main:
                    work.append((c, own, depth + 1))
    return f"{_digest(' '.join(sorted(paths))) & (1 << 64) - 1:016x}"


def _places(own: Skeleton, numbers: list[int], pairs: dict[int, int]) -> list[tuple[int, str]]:
    """Where each block is: the matched number of the nearest matched element around its own, and the tags from there.

    Elements with the same tag under one parent are one place, so how many come before does not matter.
    """
    ups: list[tuple[int, str]] = [(-1, "")] * own.size
    work = [own]
    while work:
        a = work.pop()
        for c in a.children:
            ups[c.number] = (a.number, c.tag)
        work.extend(a.children)
    out = []
    for k in numbers:
        at, tag = ups[k]
        path = [tag]
        while at >= 0 and at not in pairs:
            at, tag = ups[at]
            path.append(tag)
        out.append((pairs[max(at, 0)], "/".join(reversed(path))))
    return out


def extract(
    pages: DataFrame,
    wrapper: Wrapper = Wrapper(),
    page_id: str = "page_id",
    url: str = "url",
    page: str = "html",
) -> DataFrame:
    """Main text of each page: ``page_id``, ``url``, ``text`` (blocks joined by line ends), ``n_chars``.

    1. Pages are parsed once: their blocks, their tree of block elements, and a digest of its outer elements, the layout.
    2. The pages of a host are grouped by layout. Those of a layout with fewer than ``wrapper.pages`` pages join the
       most common layout of the host. The page of each layout whose length is nearest to the mean gives the frame.
    3. Every page is aligned with its frame by simple tree matching, inside of articles too. A block votes for its
       text at its place: the frame's node around it and the tags from there. Pages that are equal vote once.
    4. A text at a place is template if enough pages have it: ``wrapper.share`` of those aligned with the node.
    5. The text of a page is what is not template, without menus, headers, footers, sidebars, notices, adverts, forms,
       scripts, styles and comments as elements, roles and classes mark them; ``chosen`` says what stays nevertheless,
       and when an article decides over what is outside of it.

    Character references are decoded, white space inside a block becomes one space. A page with
    null or empty HTML gives an empty text; null URLs have the empty host. Equal rows give equal rows. An
    empty table gives an empty result. A host with a third of all pages is dealt over tasks: its frames are
    a row each, its counts are combined before the shuffle.
    """
    host, _ = parts(F.col(f"`{url}`"))
    kind = dict(pages.dtypes)[page_id]
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"),
        host.alias("host"), F.coalesce(F.col(f"`{page}`"), F.lit("")).alias("html"),
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = batch["html"].to_pylist()
            layout, shape, out = [], [], {n: [] for n in ("texts", "digests", "numbers", "inside", "aside", "up", "content", "firm")}
            for source in sources:
                root = parse(source)
                found, asides = listed(root, _numbers(root, {}))
                layout.append(_layout(root))
                shape.append(json.dumps(_frame(root), separators=(",", ":")))
                out["texts"].append([b.text for b in found])
                out["digests"].append([_digest(b.text) for b in found])
                for name in ("number", "inside", "aside"):
                    out["numbers" if name == "number" else name].append([getattr(b, name) for b in found])
                for name in ("up", "content", "firm"):
                    out[name].append([getattr(a, name) for a in asides])
            columns = {"page_id": batch["page_id"], "url": batch["url"], "host": batch["host"]}
            columns |= {"layout": pa.array(layout, pa.string()), "size": pa.array([len(x) for x in sources], pa.int64())}
            columns["shape"] = pa.array(shape, pa.string())
            kinds = {"texts": pa.string(), "digests": pa.int64(), "inside": pa.bool_()}
            columns |= {n: pa.array(v, pa.list_(kinds.get(n, pa.int32()))) for n, v in out.items()}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = (
        f"page_id {kind}, url string, host string, layout string, size long, shape string, texts array<string>, "
        "digests array<long>, numbers array<int>, inside array<boolean>, aside array<int>, up array<int>, "
        "content array<int>, firm array<int>"
    )
    found = stored(rows.mapInArrow(read, schema), "wrapper-pages")

    layouts = stored(
        found.groupBy("host", "layout").agg(F.count("*").alias("n"), F.avg("size").alias("mean")), "wrapper-layouts"
    )
    common = layouts.groupBy("host").agg(F.max(F.struct("n", "layout")).alias("most"), F.sum("n").alias("pages"))
    layouts = stored(
        layouts.join(common, "host").where(F.col("pages") >= wrapper.pages).select(
            "host", "layout", "mean",
            F.when(F.col("n") >= wrapper.pages, F.col("layout")).otherwise(F.col("most.layout")).alias("group"),
        ),
        "wrapper-groups",
    )
    sized = found.select("host", "layout", "size", "shape").join(layouts.where("layout = group"), ["host", "layout"])
    near = F.struct(F.abs(F.col("size") - F.col("mean")).alias("far"), F.col("shape").alias("frame"))
    frames = sized.groupBy("host", "group").agg(F.min(near).alias("near")).select("host", "group", F.col("near.frame").alias("frame"))
    frames = stored(
        layouts.select("host", "layout", "group").join(stored(frames, "wrapper-nearest"), ["host", "group"]), "wrapper-frames"
    )

    def places(memo: dict, shape: str, frame: str, numbers: list[int]) -> tuple[list[tuple[int, str]], dict[int, int]]:
        if memo.get("frame") != frame:
            memo.clear()
            memo |= {"frame": frame, "tree": Skeleton.read(json.loads(frame), [0]), "weights": {}}
        if len(memo["weights"]) > 100_000:
            memo["weights"].clear()
        own, pairs = Skeleton.read(json.loads(shape), [0]), {}
        match(own, memo["tree"], pairs, memo["weights"])
        return _places(own, numbers, pairs), pairs

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in (b.slice(k, 1000) for b in batches for k in range(0, b.num_rows, 1000)):
            nodes, votes = [], []
            for shape, frame, numbers, digests in zip(*[batch[c].to_pylist() for c in ("shape", "frame", "numbers", "digests")], strict=True):
                where, pairs = places(memo, shape, frame, numbers)
                nodes.append(sorted(pairs.values()))
                votes.append([{"node": n, "path": p, "digest": d} for (n, p), d in {*zip(where, digests, strict=True)}])
            kind = pa.struct([("node", pa.int32()), ("path", pa.string()), ("digest", pa.int64())])
            columns = [batch["host"], batch["group"], pa.array(nodes, pa.list_(pa.int32())), pa.array(votes, pa.list_(kind))]
            yield pa.RecordBatch.from_arrays(columns, ["host", "group", "nodes", "votes"])

    voters = (
        found.select("host", "layout", "shape", "numbers", "digests").join(frames, ["host", "layout"])
        .withColumn("page", F.xxhash64("shape", "numbers", "digests"))
        .dropDuplicates(["host", "group", "page"]).drop("page", "layout")
    )
    cast = "host string, group string, nodes array<int>, votes array<struct<node int, path string, digest long>>"
    each = F.concat(
        F.transform("nodes", lambda n: F.struct(n.alias("node"), F.lit(None).cast("string").alias("path"), F.lit(None).cast("long").alias("digest"))),
        F.col("votes"),
    )
    counts = stored(
        voters.mapInArrow(vote, cast).select("host", "group", F.explode(each).alias("v"))
        .groupBy("host", "group", "v.node", "v.path", "v.digest").agg(F.count("*").alias("n"))
        .where(F.col("n") >= wrapper.pages),
        "wrapper-votes",
    )
    aligned = counts.where("path IS NULL").select("host", "group", "node", F.col("n").alias("pages"))
    template = stored(
        counts.where("path IS NOT NULL").join(aligned, ["host", "group", "node"])
        .where(F.col("n") >= wrapper.share * F.col("pages"))
        .groupBy("host", "group").agg(F.collect_set(F.concat_ws(" ", "node", "path", "digest")).alias("template")),
        "wrapper-template",
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in (b.slice(k, 100) for b in batches for k in range(0, b.num_rows, 100)):
            texts = []
            for x in batch.to_pylist():
                own = [Block(*b) for b in zip(x["texts"], x["numbers"], x["inside"], x["aside"], strict=True)]
                asides = [Aside(*a) for a in zip(x["up"], x["content"], x["firm"], strict=True)]
                constant = [False] * len(own)
                if x["template"]:
                    known = set(x["template"])
                    where, _ = places(memo, x["shape"], x["frame"], x["numbers"])
                    constant = [f"{n} {p} {d}" in known for (n, p), d in zip(where, x["digests"], strict=True)]
                texts.append("\n".join(b.text for b in chosen(own, asides, constant)))
            columns = [batch["page_id"], batch["url"], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])

    known = stored(frames.join(template, ["host", "group"]).drop("group"), "wrapper-known")
    return (
        found.join(known, ["host", "layout"], "left").drop("host", "layout", "size")
        .mapInArrow(write, f"page_id {kind}, url string, text string")
        .withColumn("n_chars", F.length("text").cast("long"))
    )
