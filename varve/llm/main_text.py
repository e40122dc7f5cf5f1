"""Main text of web pages: site templates out, then the article's blocks.

Element subtrees outside the article, and those inside it that are no paragraphs, are hashed, and counted per
host in Spark by the number of different pages that hold them. Subtrees that recur on ``MIN_PAGES``
pages, however many the host has, are the site's template and are deleted. Of the rest, elements that are page
furniture by their kind or class go too, and what remains of the article (else of the main part, else of
the body) is the main text.

An article's own paragraphs are never template: reprints of an article stay whole. So what holds text of an
article is counted by the different articles beside it, told apart by their first heading and longest own block, and not on
pages where it has more than half of the article's text.

Defined results: a null or empty page gives the empty text; a null url is a host of its own
name, the empty one; repeated pages count once and each keeps its row; a tag that the page's end cuts off is
dropped, open elements end with the page; columns ``text`` and ``n_chars`` are replaced.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve.llm.columns import as_strings
from varve.session import written

#: A subtree is template on so many different pages of a host.
MIN_PAGES = 3

VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes".split())
DROPPED = set(
    "head script style noscript template iframe object svg math canvas audio video "
    "nav footer aside form button select textarea dialog menu".split()
)
BLOCKS = set(
    "address article aside blockquote body caption dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose subtrees may be template.
CANDIDATES = set("aside div dl footer form header nav ol p section table ul".split())
#: The same inside an article or main part.
CANDIDATES_INSIDE = CANDIDATES - {"p"} | {"article", "details", "fieldset", "figure"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
FURNITURE = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice "
    "notices popup modal sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead comment comments "
    "disqus reply replies share sharing social related newsletter subscribe toolbar contentinfo complementary".split()
)
#: Words that stand beside those in the names of furniture.
COMPANIONS = set(
    "area bar block body box btn button buttons container content entry form group header heading icon icons inner "
    "item items label left link links list main media meta module outer page post posts panel right section signup site "
    "text thread title top bottom widget wrap wrapper stories articles tools".split()
)
#: What a start tag ends when it is open and innermost of its kind, up to an element of the last set.
ENDS_SAME = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")


def _digest(parts: list[str]) -> str:
    return hashlib.blake2b("\x00".join(parts).encode("utf-8", "replace"), digest_size=8).hexdigest()


class _Element:
    __slots__ = ("tag", "dropped", "place", "inner", "number", "near", "heading")

    def __init__(self, tag, dropped, place, inner, number, above=None):
        self.tag, self.dropped, self.place, self.inner, self.number = tag, dropped, place, inner, number
        # the innermost candidate here, and whether this is in a heading
        self.near = number if number is not None or above is None else above.near
        self.heading = tag in HEADINGS or above is not None and above.heading


class _Firsts:
    """The first of an order of blocks that lies outside given ranges of them."""

    def __init__(self, order: list[int], count: int):
        self.order = order
        self.rank = [len(order)] * count
        for place, block in enumerate(order):
            self.rank[block] = place
        self.before = [len(order), *accumulate(self.rank, min)]
        self.after = [*accumulate(reversed(self.rank), min)][::-1] + [len(order)]

    def outside(self, ranges: list[tuple[int, int]]) -> int | None:
        """``ranges`` are in page order and apart from each other."""
        between = (min(self.rank[end:first], default=len(self.order)) for (_, end), (first, _) in pairwise(ranges))
        place = min(self.before[ranges[0][0]], self.after[ranges[-1][1]], *between)
        return self.order[place] if place < len(self.order) else None


class PageBlocks:
    """Text blocks of one page, and the hashes of its subtrees that may be template."""

    def __init__(self, page: str):
        self.stack = [_Element("", False, "body", [], None)]
        self.open: Counter[str] = Counter()
        self.hashes: list[str | None] = []
        self.parents: list[int | None] = []
        self.found: list[tuple[str, str, int | None, bool]] = []
        self.text: list[str] = []
        self._read(page)
        self._flush()
        while len(self.stack) > 1:
            self._pop()

    def blocks(self) -> list[str]:
        """Texts of the best part that the page has."""
        return [text for text, _, _, _ in self._best()]

    def ranges(self) -> list[tuple[str, int, int]]:
        """(hash, first, end) of each candidate that holds the blocks from ``first`` to before ``end``.

        A subtree's blocks are neighbours, so two numbers tell them, however deep the page is.
        """
        count = len(self.hashes)
        first, end = [len(self.found)] * count, [0] * count
        for i, (_, _, near, _) in enumerate(self._best()):
            if near is not None:
                first[near], end[near] = min(first[near], i), i + 1
        # an element opens after those around it, so its number is greater
        for number in range(count - 1, -1, -1):
            above = self.parents[number]
            if above is not None:
                first[above], end[above] = min(first[above], first[number]), max(end[above], end[number])
        return [(self.hashes[n], first[n], end[n]) for n in range(count) if end[n]]

    def subtrees(self) -> dict[str, str | None]:
        """Hash of each candidate to what tells its page from others: None is the page itself.

        Candidates that have most of an article are left out.
        """
        votes = dict.fromkeys(self.hashes)
        best = self._best()
        if not best or best[0][1] == "body":
            return votes
        sums = [0, *accumulate(len(text) for text, _, _, _ in best)]
        held: dict[str, list[tuple[int, int]]] = {}
        for subtree, first, end in self.ranges():
            held.setdefault(subtree, []).append((first, end))
        most = {h for h, ranges in held.items() if 2 * sum(sums[end] - sums[first] for first, end in ranges) > sums[-1]}
        own: list[bool] = []
        for number, above in enumerate(self.parents):
            own.append(self.hashes[number] in most and (above is None or own[above]))
        # the article's own blocks, which nothing smaller encloses, come before all others
        by_length = sorted(range(len(best)), key=lambda i: (not (best[i][2] is None or own[best[i][2]]), -len(best[i][0])))
        headings = [i for i in range(len(best)) if best[i][3]]
        orders = [_Firsts(order, len(best)) for order in (headings, by_length)]
        for subtree, ranges in held.items():
            if subtree in most:
                del votes[subtree]
                continue
            beside = [order.outside(ranges) for order in orders]
            votes[subtree] = _digest(["" if i is None else best[i][0] for i in beside])
        return votes

    def _best(self) -> list[tuple[str, str, int | None, bool]]:
        for place in ("article", "main", "body"):
            kept = [block for block in self.found if block[1] == place]
            if kept:
                return kept
        return []

    def _read(self, page: str) -> None:
        at = 0
        while True:
            tag = _TAG.search(page, at)
            if tag is None:
                self._add(page[at:])
                return
            if tag.start() > at:
                self._add(page[at : tag.start()])
            at = tag.end()
            name = tag[2] or tag[5]
            if not name:
                continue
            if page[at - 1] != ">":
                return  # the page ends within the tag
            name = name.lower()
            if tag[1] or tag[4]:
                self._close(name)
                continue
            given = tag[3] or tag[6] or ""
            self._open(name, given)
            if name in RAW:
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                self.stack[-1].inner.append(page[at : end.start() if end else len(page)])
                at = end.end() if end else len(page)
                self._close(name)

    def _add(self, raw: str) -> None:
        element = self.stack[-1]
        element.inner.append(raw)
        if not element.dropped:
            self.text.append(raw)

    def _flush(self) -> None:
        if self.text:
            words = html.unescape("".join(self.text)).split()
            self.text = []
            if words:
                element = self.stack[-1]
                self.found.append((" ".join(words), element.place, element.near, element.heading))

    def _open(self, name: str, given: str) -> None:
        if name in BLOCKS:
            self._flush()
            if name not in ("body", "html"):
                self._end_open({"p"}, {"article", "main", "table", "td", "th", "button"}) if name not in (
                    "li dt dd tr td th caption tbody thead tfoot".split()
                ) else None
        if name in ENDS_SAME:
            self._end_open(*ENDS_SAME[name])
        if name == "br":
            self.text.append(" ")
        if name in VOID:
            self.stack[-1].inner.append(f"<{name}>")
            return
        above = self.stack[-1]
        named = {k.lower(): v.strip("\"'").lower() for k, v in _NAMED.findall(given)} if given else {}
        words = set(_WORD.findall(" ".join(named.values())))
        if above.place != "body":
            # one word of a longer name may be the article's subject: there the whole name must say furniture
            names = (set(_WORD.findall(n)) for n in " ".join(named.values()).split())
            words = set().union(*(n for n in names if n <= FURNITURE | COMPANIONS))
        dropped = above.dropped or name in DROPPED
        if name == "header":
            dropped = dropped or above.place == "body"
        if name in ("article", "main"):
            dropped = dropped or bool(words & {"comment", "comments", "reply", "replies"})
        elif name not in ("html", "body"):
            dropped = dropped or bool(words & FURNITURE)
        place = above.place
        if not dropped and (name == "article" or name == "main" and place == "body"):
            place = name
        number = None
        # the outermost article or main part is no candidate: all of its text is in it
        if name in CANDIDATES if place == "body" else name in CANDIDATES_INSIDE and above.place != "body":
            number = len(self.hashes)
            self.hashes.append(None)
            self.parents.append(above.near)
        head = " ".join([name, *(f"{k}={v}" for k, v in sorted(named.items()))])
        self.stack.append(_Element(name, dropped, place, [head], number, above))
        self.open[name] += 1

    def _end_open(self, tags: set[str], until: set[str]) -> None:
        if not any(self.open[tag] for tag in tags):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in tags:
                self._flush()
                while len(self.stack) > depth:
                    self._pop()
                return
            if self.stack[depth].tag in until:
                return

    def _close(self, name: str) -> None:
        if name in BLOCKS:
            self._flush()
        if not self.open[name]:
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == name:
                while len(self.stack) > depth:
                    self._pop()
                return
            if self.stack[depth].tag in ("article", "main") and name not in ("article", "main", "body", "html"):
                return  # a stray end tag doesn't end the article

    def _pop(self) -> None:
        if self.stack[-1].tag in BLOCKS:
            self._flush()
        element = self.stack.pop()
        self.open[element.tag] -= 1
        # whatever the element is: what holds an article recurs only if the article does
        hashed = _digest(element.inner)
        self.stack[-1].inner.append(hashed)
        if element.number is not None:
            self.hashes[element.number] = hashed


def host() -> F.Column:
    """The host of ``url`` in lower case, without user and port."""
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


_PARSED = T.StructType(
    [
        T.StructField("blocks", T.ArrayType(T.StringType())),
        T.StructField(
            "ranges",
            T.ArrayType(
                T.StructType(
                    [T.StructField("subtree", T.StringType()), T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())]
                )
            ),
        ),
        T.StructField("subtrees", T.ArrayType(T.StructType([T.StructField("subtree", T.StringType()), T.StructField("vote", T.StringType())]))),
    ]
)


def _parse(batches):
    kinds = {
        "blocks": pa.list_(pa.string()),
        "ranges": pa.list_(pa.struct([("subtree", pa.string()), ("first", pa.int32()), ("end", pa.int32())])),
        "subtrees": pa.list_(pa.struct([("subtree", pa.string()), ("vote", pa.string())])),
    }
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            at = part.schema.get_field_index("html")
            found = {name: [] for name in kinds}
            for page in as_strings(part.column(at)).to_pylist():
                parsed = PageBlocks(page)
                found["blocks"].append(parsed.blocks())
                found["ranges"].append([{"subtree": s, "first": a, "end": b} for s, a, b in parsed.ranges()])
                found["subtrees"].append([{"subtree": s, "vote": v} for s, v in parsed.subtrees().items()])
            columns = [c for i, c in enumerate(part.columns) if i != at]
            names = [n for i, n in enumerate(part.schema.names) if i != at]
            lists = [pa.array(found[name], kind) for name, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([*columns, *lists], [*names, *kinds])


def parsed_pages(pages: DataFrame) -> DataFrame:
    """``pages`` without ``html``, with ``site``, ``page_hash``, ``blocks``, ``ranges`` and ``subtrees``."""
    keyed = pages.select(
        *[c for c in pages.columns if c not in ("text", "n_chars", "site", "page_hash", "blocks", "ranges", "subtrees")],
        host().alias("site"),
        F.xxhash64("html", F.lit(1)).alias("page_hash"),
    )
    fields = [f for f in keyed.schema.fields if f.name != "html"]
    return keyed.mapInArrow(_parse, T.StructType([*fields, *_PARSED.fields]))


def site_templates(parsed: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(site, subtree) of the subtrees that recur across many different pages of their site."""
    return (
        parsed.select("site", "page_hash", F.explode("subtrees").alias("held"))
        .select("site", "held.subtree", F.coalesce("held.vote", F.col("page_hash").cast("string")).alias("vote"))
        .distinct()
        .groupBy("site", "subtree")
        .agg(F.count(F.lit(1)).alias("held"))
        .where(F.col("held") >= min_pages)
        .select("site", "subtree")
    )


def extract_main_text(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` without ``html``, with ``text`` (blocks joined by an empty line) and ``n_chars``."""
    parsed = written(parsed_pages(pages), "pages")
    templates = site_templates(parsed, min_pages)
    # a block with no candidate around it can't be template, so texts without such need not meet the list
    open_ = F.size("ranges") > 0
    deleted = (
        parsed.where(open_)
        .select("site", "page_hash", F.explode("ranges").alias("held"))
        .select("site", "page_hash", "held.subtree", "held.first", "held.end")
        .distinct()
        .join(templates, ["site", "subtree"])
        .groupBy("site", "page_hash")
        .agg(F.collect_set(F.struct("first", "end")).alias("deleted"))
    )
    kept = F.filter(
        "blocks",
        lambda _, i: ~F.coalesce(F.exists("deleted", lambda r: (r["first"] <= i) & (i < r["end"])), F.lit(False)),
    )
    text = F.array_join(kept, "\n\n")
    joined = parsed.where(open_).join(deleted, ["site", "page_hash"], "left").select(*parsed.columns, "deleted")
    sure = parsed.where(~open_).withColumn("deleted", F.array().cast("array<struct<first:int,end:int>>"))
    joined = sure.unionByName(joined).withColumn("text", text)
    names = [c for c in pages.columns if c not in ("html", "text", "n_chars", "site", "page_hash", "blocks", "ranges", "subtrees")]
    return joined.select(*names, "text", F.length("text").cast("bigint").alias("n_chars"))
