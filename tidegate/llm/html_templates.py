"""Main text of web pages by equivalence-class template deduction.

Pages of one host come from one template. A page is a sequence of tokens: its tags,
told apart by their path, and its text blocks, told apart by path and content. Tokens
that occur equally often in each page of a host (equal occurrence vectors) form an
equivalence class; classes with enough support and more than one token are valid and
make up the template.

The template is nested by the tags it has once in every page: each holds those below it,
and the slots are what is left between template tokens. A tag is told apart twice, by the
labels on its path, which stands up to elements that come and go, and by its place among
its siblings as well, which tells apart elements that nothing names. Over all pages of the
host, the text in slots is summed below every such tag (links and the template's own texts
do not count): the innermost tag that holds most of it, ``SHARE``, is the content element, and the
slots outside it are layout, whatever they say and whatever they are called.

Names (tags, roles, words in class and id) then only refine that: they take advertisements, forms
and comments out of the content element, and an article in it narrows it down. Pages that lack
the content element, and hosts with fewer than ``MIN_PAGES`` different pages, which have no
template, are read by names alone: there an article or main element is the content, and
a word can make it layout only if it is one whole name, like "comment", and not part of one,
like "comments-open"; a name of state around it, like "has-sidebar", does not reach into it.

Pages of a host with equal html are one page there: copies say nothing about what a
template repeats, and would make all their text look like it.

An occurrence vector is as long as a host has pages, so it is not gathered: it is
folded to the sum of a 64-bit hash of (page, count) over the pages, kept as the sums
of both halves, which adds up in any order, on the map side first. A host may hold any
share of all pages.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import fields, stored

MIN_PAGES = 10
#: A class is in the template if it is in at least this share of the host's pages.
SUPPORT = 0.8
LINKS = 0.5
#: The content element holds at least this share of the text in slots.
SHARE = 0.6
#: Above so many hosts with templates these are joined by shuffle instead of broadcast.
BROADCAST_HOSTS = 20_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font",
    "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
    "strong", "sub", "sup", "time", "tt", "u", "var",
}
#: Elements that a start tag of the key ends, if they are open within the nearest container.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
CONTAINERS = {"ul", "ol", "dl", "table", "select", "article", "section", "div", "body", "main", "nav", "aside"}

CHROME_TAGS = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "fieldset"}
CHROME_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "alertdialog",
    "menu", "menubar", "form",
}
#: Words in class or id that name layout: what is no content wherever it stands ...
CHROME_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertisements", "adsense", "sponsor", "sponsored",
    "comment", "comments", "disqus", "respond", "reply", "replies", "cookie", "cookies", "consent", "gdpr",
    "newsletter", "related", "recommended", "masthead",
}
#: ... and what may also be a state or a part of the page around an article.
STATE_WORDS = {
    "promo", "promotion", "banner", "sidebar", "nav", "navbar", "navigation", "menu", "breadcrumb",
    "breadcrumbs", "footer", "notice", "notices", "alert", "popup", "modal", "overlay", "subscribe",
    "subscription", "signup", "login", "share", "sharing", "social", "widget", "toolbar", "pagination",
    "pager", "hidden",
}
#: In a name of several words the last one says what it is, unless it is one of these.
PARTS = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "form",
    "group", "inner", "item", "items", "left", "link", "links", "list", "outer", "panel", "right",
    "row", "section", "slot", "thread", "title", "top", "unit", "wrap", "wrapper",
}
HAVING = {"has", "have", "is", "no", "show", "with", "without"}
#: Elements of a text that words do not make layout.
TEXTUAL = {"figure", "figcaption", "blockquote", "pre", "table"}

#: What a block stands in: layout, layout by a name of state, nothing known, a marked article,
#: the content element, and an article in the content element.
CHROME, HUSHED, PLAIN, MARKED, INSIDE, BOTH = -2, -1, 0, 1, 2, 3

Block = tuple[int, int, str, int, int]  # path, role, text, characters of it in links, place


def named_layout(names: str, whole: bool = False) -> int:
    """CHROME or HUSHED if a class or id names layout, else PLAIN; ``whole`` takes single words only."""
    found = PLAIN
    for name in names.split():
        parts = [w for w in re.split(r"[^a-z0-9]+", name) if w]
        if not parts or len(parts) > 1 and (whole or parts[0] in HAVING):
            continue
        said = parts[0] if parts[-1] in PARTS else parts[-1]
        if said in CHROME_WORDS:
            return CHROME
        if said in STATE_WORDS and not whole:
            found = HUSHED
    return found


def role(tag: str, attrs: str, within: int, content: bool = False) -> tuple[int, str]:
    """What an element is for, given what it stands in, and the label it has in paths.

    ``content`` tells that the template has it as the content element.
    """
    values = {k.lower(): html.unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(attrs)}
    names = " ".join(values.get(k, "") for k in ("class", "id")).lower()
    label = f"{tag}.{' '.join(sorted(values.get('class', '').lower().split()))}"
    said = values.get("role", "").lower()
    article = tag in ("article", "main") or said in ("article", "main")
    if content:
        return BOTH if article or within in (MARKED, BOTH) else INSIDE, label
    style = values.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in values or values.get("aria-hidden", "").lower() == "true" or "display:none" in style
    header = within < MARKED and (tag == "header" or "header" in re.split(r"[^a-z0-9]+", names))
    if within == CHROME or tag in CHROME_TAGS or said in CHROME_ROLES or hidden or header:
        return CHROME, label
    if tag not in ("html", "body") and tag not in TEXTUAL:
        layout = named_layout(names, article)
        if layout < PLAIN:
            return layout, label
    if article:
        return BOTH if within in (INSIDE, BOTH) else MARKED, label
    return within, label


class Tag:
    """An open or closed element: its path and place, those of its parent, and the text below it."""

    __slots__ = ("tag", "path", "place", "role", "parent", "chars", "linked", "children")

    def __init__(self, tag: str, path: int, place: int, role: int, parent: Tag | None, chars: int, linked: int):
        self.tag, self.path, self.place, self.role, self.parent = tag, path, place, role, parent
        self.chars, self.linked = chars, linked  # up to its start; below it once it is closed
        self.children: dict[str, int] = {}

    def holds(self) -> bool:
        """Whether it may be a content element: it has elements in it, or a longer text."""
        return bool(self.children) or self.chars >= 200


def parse(page: str, contents: frozenset[int] = frozenset()) -> tuple[list[Tag], list[Block]]:
    """A page's structural tags in order, and its text blocks.

    ``contents`` has paths and places of content elements. Time is in proportion to the page:
    the open elements of each tag are known by their place on the stack.
    """
    tags: list[Tag] = []
    blocks: list[Block] = []
    stack: list[Tag] = [Tag("", 0, 0, PLAIN, None, 0, 0)]
    opened: dict[str, list[int]] = {}
    held: list[str] = []
    linked, links, chars, chars_linked = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked, chars, chars_linked
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            top, in_links = stack[-1], min(linked, len(text))
            blocks.append((top.path, top.role, text, in_links, top.place))
            chars += len(text)
            chars_linked += in_links
        held.clear()
        linked = 0

    def hold(text: str) -> None:
        nonlocal linked
        held.append(text)
        if links:
            linked += len(text.strip())

    def close(to: int) -> None:
        """Close the elements from place ``to`` of the stack on."""
        while len(stack) > to:
            done = stack.pop()
            opened[done.tag].pop()
            done.chars, done.linked = chars - done.chars, chars_linked - done.linked

    def innermost(names) -> int:
        """The place of the innermost open element of these names; 0 without one."""
        return max((opened[n][-1] for n in names if opened.get(n)), default=0)

    at, n = 0, len(page)
    while at < n:
        match = TOKEN.search(page, at)
        if match is None:
            hold(page[at:])
            break
        if match.start() > at:
            hold(page[at : match.start()])
        at = match.end()
        tag = (match["tag"] or match["tag2"] or "").lower()
        if not tag:
            continue  # a comment or a declaration
        end = bool(match["end"] or match["end2"])
        if tag in RAW:
            if not end:
                closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(page, at)
                at = closing.start() if closing else n
            continue
        if tag in INLINE or tag in VOID:
            if tag == "a":
                links = max(0, links + (-1 if end else 1))
            elif tag == "br":
                held.append(" ")
            elif tag == "hr":
                flush()
            continue
        flush()
        links = 0
        if end:
            if opened.get(tag):
                close(opened[tag][-1])
            continue
        if stack[-1].tag == "p":
            close(len(stack) - 1)  # a block ends a paragraph
        if tag in ENDS and innermost(ENDS[tag]) > innermost(CONTAINERS):
            close(innermost(ENDS[tag]))
        parent = stack[-1]
        attrs = match["attrs"] or match["attrs2"] or ""
        kind, label = role(tag, attrs, parent.role)
        path = xxhash.xxh64_intdigest(label, parent.path)
        number = parent.children[tag] = parent.children.get(tag, 0) + 1
        place = xxhash.xxh64_intdigest(f"{tag} {number}", parent.place ^ 2)
        if contents and tag not in ("html", "body") and (path in contents or place in contents):
            kind = role(tag, attrs, parent.role, True)[0]
        opened.setdefault(tag, []).append(len(stack))
        stack.append(Tag(tag, path, place, kind, parent, chars, chars_linked))
        tags.append(stack[-1])
    flush()
    close(1)
    return tags, blocks


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def token_of(block: Block) -> int:
    return xxhash.xxh64_intdigest(block[2], block[0] ^ 1)


def host_of(url: str | None) -> str:
    match = re.match(r"\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return match[1].lower() if match else ""


def host(url: Column) -> Column:
    """``host_of`` as built-in functions."""
    name = F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(name)


TAG, TEXT, SLOT, PAGE, PLACE = 0, 1, 2, 3, 4


def tokens(pages: DataFrame) -> DataFrame:
    """(host, kind, token, pages, times, high, low, chars, linked, above, beside), summed within each batch.

    Takes host and html, each different page of a host once. ``chars`` are those below a
    tag or in a text. ``above`` is the path or place that holds a token, ``beside`` the
    place that holds a text.
    """
    sums = ("pages", "times", "high", "low", "chars", "linked")
    whole = ("token", *sums, "above", "beside")
    kinds = "host string, kind int, " + ", ".join(f"{n} bigint" for n in whole)
    schema = pa.schema([("host", pa.string()), ("kind", pa.int32())] + [(n, pa.int64()) for n in whole])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, int, int], list[int]] = {}
            rows = zip(*[batch.column(c).to_pylist() for c in ("host", "html")], strict=True)
            for host, page in rows:
                tags, blocks = parse(page)
                content = xxhash.xxh64_intdigest(page)
                counts: dict[tuple[str, int, int], list[int]] = {(host, PAGE, 0): [1, 0, 0, 0, 0]}

                def add(kind: int, token: int, chars: int, linked: int, above: int = 0, beside: int = 0) -> None:
                    have = counts.setdefault((host, kind, token), [0, 0, 0, above, beside])  # noqa: B023
                    have[0] += 1
                    have[1] += chars
                    have[2] += linked

                for tag in tags:
                    add(TAG, tag.path, tag.chars, tag.linked, tag.parent.path)
                    if tag.holds():
                        add(PLACE, tag.place, tag.chars, tag.linked, tag.parent.place)
                for block in blocks:
                    add(TEXT, token_of(block), len(block[2]), block[3], block[0], block[4])
                    add(SLOT, block[0], len(block[2]), block[3])
                for key, (times, chars, linked, above, beside) in counts.items():
                    vector = xxhash.xxh64_intdigest(f"{content} {times}")
                    have = found.setdefault(key, [0, 0, 0, 0, 0, 0, signed(above), signed(beside)])
                    have[0] += 1
                    have[1] += times
                    have[2] += vector >> 32
                    have[3] += vector & 0xFFFFFFFF
                    have[4] += chars
                    have[5] += linked
            keys, rows_of = list(zip(*found)), list(zip(*found.values()))
            if not keys:
                continue
            columns = [keys[0], keys[1], map(signed, keys[2]), *rows_of]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    return pages.mapInArrow(of, kinds)


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, support: float = SUPPORT) -> DataFrame:
    """(of_host, layout, menus, contents): a host's template texts, slots of mostly links, content element.

    Classes are the groups of tags and texts with one vector; valid ones have the
    support and at least two tokens, one of them a tag, and their texts lie once in a
    page. The number of rows a host has here does not grow with its pages. Pages are
    the different ones: rows with equal html count as one page of their host.
    """
    different = pages.select(host(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html")).distinct()
    sums = [F.sum(c).alias(c) for c in ("pages", "times", "high", "low", "chars", "linked")]
    summed = stored(
        tokens(different)
        .groupBy("host", "kind", "token")
        .agg(*sums, F.min("above").alias("above"), F.min("beside").alias("beside"))
        .where(F.col("kind").isin(SLOT, PAGE) | (F.col("pages") >= support * min_pages)),
        "page-tokens",
    )
    hosts = summed.where((F.col("kind") == PAGE) & (F.col("pages") >= min_pages)).select(
        F.col("host").alias("of_host"), F.col("pages").alias("of_pages")
    )
    common = summed.where(F.col("kind") != PAGE).join(hosts, F.col("host") == F.col("of_host")).where(
        F.col("pages") >= support * F.col("of_pages")
    )

    def deduce(table: pa.Table) -> pa.Table:
        return pa.table([table["of_host"][:1].cast(pa.string()), *(pa.array([x], ids) for x in template(table))], schema=out)

    ids = pa.list_(pa.int64())
    out = pa.schema([("of_host", pa.string()), ("layout", ids), ("menus", ids), ("contents", ids)])
    lists = ", ".join(f"{f.name} array<bigint>" for f in list(out)[1:])
    return common.groupBy("of_host").applyInArrow(deduce, f"of_host string, {lists}")


def template(table: pa.Table) -> tuple[list[int], list[int], list[int]]:
    """Layout texts, menu slots and content elements of a host, from its tokens with support."""
    rows = table.select(["kind", "token", "pages", "times", "high", "low", "chars", "linked", "above", "beside"])
    by_kind = {kind: rows.filter(pc.equal(rows["kind"], kind)).to_pylist() for kind in (TAG, TEXT, SLOT, PLACE)}
    members: dict[tuple[int, int], list[dict]] = {}
    for row in by_kind[TAG] + by_kind[TEXT]:
        members.setdefault((row["high"], row["low"]), []).append(row)
    texts = [
        row
        for members_ in members.values()
        if len(members_) > 1 and any(r["kind"] == TAG for r in members_)
        for row in members_
        if row["kind"] == TEXT and row["times"] == row["pages"]
    ]
    menus = [row["token"] for row in by_kind[SLOT] if row["linked"] > LINKS * row["chars"]]
    nests = [(by_kind[TAG], "above"), (by_kind[PLACE], "beside")]
    best = min((c for nest, holder in nests for c in [content_element(nest, texts, holder)] if c), default=None)
    return [row["token"] for row in texts], menus, [best[-1]] if best else []


def content_element(tags: list[dict], texts: list[dict], holder: str) -> tuple[int, int, int] | None:
    """The innermost of the tags once in a page that hold most of the text in slots.

    Given as its share of that text, its depth with the deepest first, and its token.
    """
    nodes = {row["token"]: row for row in tags if row["times"] == row["pages"]}

    def around(token: int) -> Iterator[int]:
        while token in nodes:
            yield token
            token = nodes[token]["above"]

    slots = {token: row["chars"] - row["linked"] for token, row in nodes.items()}
    for text in texts:
        for token in around(text[holder]):
            slots[token] -= text["chars"] - text["linked"]
    most = max(slots.values(), default=0)
    if most <= 0:
        return None
    return min((n, -len(list(around(token))), token) for token, n in slots.items() if n >= SHARE * most)


def main_text(
    page: str | None, layout: set[int], menus: set[int], contents: frozenset[int] = frozenset()
) -> str:
    """The blocks of a page's content slots, joined by line ends."""
    _, blocks = parse(page or "", contents)
    best = max((block[1] for block in blocks), default=PLAIN)
    kept = []
    for block in blocks:
        if block[1] < PLAIN or block[1] != best and best >= MARKED:
            continue
        if signed(token_of(block)) in layout or best in (PLAIN, INSIDE) and signed(block[0]) in menus:
            continue
        kept.append(block[2])
    return "\n".join(kept)


def extract(
    pages: DataFrame,
    min_pages: int = MIN_PAGES,
    support: float = SUPPORT,
    broadcast_hosts: int = BROADCAST_HOSTS,
) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Null or empty html gives the empty text. Pages without a url form one host.
    Rows with equal html count once for the template of their host. A page without content
    element and without an article gives its body's blocks that are neither layout by name nor in
    the template. Pages of any length are read whole, in time in proportion to it. Columns
    other than page_id, url and html are ignored; an empty table gives no rows.
    """
    chosen = fields(pages, "page_id", "url", "html")
    known = stored(templates(chosen, min_pages, support), "templates")
    if known.count() <= broadcast_hosts:
        known = F.broadcast(known)
    joined = chosen.join(known, host(F.col("url")) == F.col("of_host"), "left").select(
        "page_id", "url", "html", "of_host", "layout", "menus", "contents"
    )
    kind = chosen.schema["page_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, tuple] = {}
        for batch in batches:
            texts = []
            for i, (host, page) in enumerate(
                zip(batch.column("of_host").to_pylist(), batch.column("html").to_pylist(), strict=True)
            ):
                if host not in sets:
                    layout, menus = (set(batch.column(c)[i].as_py() or ()) for c in ("layout", "menus"))
                    contents = batch.column("contents")[i].as_py() or ()
                    sets[host] = layout, menus, frozenset(x & (1 << 64) - 1 for x in contents)
                texts.append(main_text(page, *sets[host]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return joined.mapInArrow(of, f"page_id {kind}, url string, text string, n_chars bigint")
