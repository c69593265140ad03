"""Main text of web pages by consensus paths of each host.

Every page is read once to score its containers: text of paragraphs, headings and list items
outside of links counts for the container it lies in, and half for the one around that. From
the best one the page climbs to the article or main element around it, or else to the lowest
element with nearly all of the text and every h1, and votes for its path, a path being tags with their
classes, digits generalised. Spark counts the votes of each host; paths with a fair share of
them win. Every page is then read again and gives the text of the elements on the first winning
path that has more than a small share of its text, or of its own container where there is none.

Pages of one host never meet in one task: votes are counted by host and path with partial
aggregation. The winners of all hosts are broadcast if their measured size is at most
``BROADCAST_BYTES``, so that pages are not moved at all; beyond that they are joined on the
host and a salt, each host's winners repeated for every salt.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import durable

VOTE_SHARE = 0.15  # of a host's pages; so a host has at most six winning paths
NEARLY = 0.93  # of a page's text, in the element it climbs to
SMALL = 0.1  # of a page's text: with less a winning path gives way to the page's own container
BROADCAST_BYTES = 8 << 20  # winners of all hosts
SALTS = 32

# Elements by role, and class words of what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe".split())
FOREIGN = frozenset("svg math".split())
SKIPPED = frozenset("nav footer aside form button dialog menu fieldset template svg select".split())
CONTAINERS = frozenset("article main section div td body center".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul".split()
)
SELF_CLOSING = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table", "option": "select"}
SKIPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar masthead header footer comment comments reply replies disqus notice "
    "notices cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login share sharing social "
    "related recommended widget toolbar pagination pager copyright legal search".split()
)
# With a skipped word and nothing else these make a whole name: "ad-box".
PLACE_WORDS = frozenset(
    "area bar block bottom box button buttons col column container desktop group holder icon icons inner item items js left "
    "link links list mobile module outer panel primary region right row secondary section site slot sticky strip top unit "
    "wrap wrapper zone".split()
)
LINKED = 0.5  # of the text of an element with a skipped word in its name: with more in links it is skipped
LAYOUT_WORDS = frozenset("has with no without is layout template page".split())  # "has-sidebar" is not a sidebar
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)|[^>]*)>", re.S
)
# Attributes one after another, values consumed whole; a quoted text without a name is passed over.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|"[^"]*"|'[^']*'""")
_DIGITS = re.compile(r"[0-9]+")


class _Element:
    """An open element. What asks about the elements around it is answered once, when it opens:
    a page nested very deep costs no more than its size."""

    __slots__ = (
        "tag", "label", "skip", "parent", "score", "total", "title", "seen", "holder", "doubt", "length", "linked", "gone",
        "foreign", "inside", "block", "link", "reach", "within",
    )

    def __init__(self, tag, label, skip, parent, doubt=False):
        self.tag, self.label, self.skip, self.parent = tag, label, skip, parent
        self.score = self.total = self.title = 0.0
        self.doubt = self if doubt else (parent.doubt if parent else None)  # innermost element of doubtful name
        self.length = self.linked = 0
        self.seen = self.gone = False
        self.foreign = tag in FOREIGN or bool(parent and parent.foreign)
        self.inside = tag in ("article", "main") or bool(parent and parent.inside)
        self.holder = self if tag in CONTAINERS else (parent.holder if parent else None)
        self.block = parent.block if parent and tag in INLINE else self  # innermost that is not inline
        self.link = tag == "a" or tag in INLINE and bool(parent and parent.link)
        self.reach, self.within = (), ()  # of wanted paths: (path, bytes so far) it may still lead to; those around it

    def path(self) -> str:
        labels, e = [], self
        while e.parent:
            labels.append(e.label)
            e = e.parent
        return "".join(f"/{label}" for label in reversed(labels))

    def follow(self, wanted: list[str]) -> None:
        """Which wanted paths begin with this element's path, and which it lies in."""
        if self.parent is None:
            self.reach = tuple((p, 0) for p in wanted)
            self.within = tuple(p for p in wanted if not p)
            return
        self.within = self.parent.within
        if self.parent.reach:
            step = "/" + self.label
            self.reach = tuple((p, n + len(step)) for p, n in self.parent.reach if p.startswith(step, n))
            for p, n in self.reach:
                if n == len(p):
                    self.within += (p,)


def _skipped_class(value: str) -> tuple[bool, bool]:
    """Whether a class or id is, as a whole name, of what is not the article; whether it begins or ends like one."""
    whole = part = False
    for name in value.lower().split():
        words = [w for w in re.split(r"[-_]+", _DIGITS.sub("", name)) if w]
        if not words or words[0] in LAYOUT_WORDS or words[-1] in LAYOUT_WORDS:
            continue
        part = part or words[0] in SKIPPED_WORDS or words[-1] in SKIPPED_WORDS
        known = [w in SKIPPED_WORDS for w in words]
        whole = whole or any(known) and all(k or w in PLACE_WORDS for k, w in zip(known, words))
    return whole, part


def _open(tag: str, attributes: str, parent: _Element | None) -> _Element:
    classes, doubt, skip = "", False, tag in SKIPPED or (tag == "header" and not (parent and parent.inside))
    for name, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), unescape(value.strip("\"'"))
        if name == "class":
            classes = ".".join(sorted(set(_DIGITS.sub("#", value).split())))
            if tag not in ("article", "main", "body", "html"):
                whole, part = _skipped_class(value)
                skip, doubt = skip or whole, doubt or part
            skip = skip or tag == "article" and value.lower().startswith(("comment", "reply", "ad-", "promo"))
        elif name == "id":
            if tag not in ("article", "main", "body", "html"):
                whole, part = _skipped_class(value)
                skip, doubt = skip or whole, doubt or part
        elif name == "role":
            skip = skip or value.lower() in SKIPPED_ROLES
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            skip = True
    label = f"{tag}.{classes}" if classes else tag
    return _Element(tag, label, skip or bool(parent and parent.skip), parent, doubt)


def pieces(html: str, wanted: list[str] = ()) -> Iterator[tuple[_Element, str, bool]]:
    """(innermost element, text, a block begins here) for the pieces of text outside raw elements.

    Elements know which of the ``wanted`` paths they lie in.
    """
    root = _Element("", "", False, None)
    root.holder = root
    if wanted:
        root.follow(wanted)
    stack, at, fresh, n = [root], 0, True, len(html)
    opened: dict[str, int] = defaultdict(int)  # by tag, of those on the stack

    def close_from(k: int) -> None:
        for e in stack[k:]:
            opened[e.tag] -= 1
        del stack[k:]

    while at < n:
        m = _TOKEN.search(html, at)
        text = html[at : m.start()] if m else html[at:]
        if text:
            yield stack[-1], unescape(text), fresh
            fresh = False
        if not m:
            return
        at = m.end()
        name = m[2]
        if name is None:
            continue
        tag = name.lower()
        if tag not in INLINE:
            fresh = True
        if m[1]:
            for k in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[k].tag == tag:
                    close_from(k)
                    break
                if tag in INLINE and stack[k].tag not in INLINE:
                    break  # a stray end tag closes nothing beyond its block
            continue
        if tag in VOID:
            continue
        if m[3].endswith("/") and (tag in FOREIGN or stack[-1].foreign):
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = close.end() if close else n
            continue
        if tag in CLOSES_PARAGRAPH:
            for k in range(len(stack) - 1, 0, -1) if opened["p"] else ():
                if stack[k].tag == "p":
                    close_from(k)
                    break
                if stack[k].tag not in INLINE:
                    break
        if tag in SELF_CLOSING:
            stop = SELF_CLOSING[tag].split()
            for k in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[k].tag == tag:
                    close_from(k)
                    break
                if stack[k].tag in stop:
                    break
        element = _open(tag, m[3], stack[-1])
        if wanted:
            element.follow(wanted)
        stack.append(element)
        opened[tag] += 1


def _shown(html: str, wanted: list[str] = ()) -> list[tuple[_Element, str, bool, bool]]:
    """Pieces that are not skipped, and whether they lie in a link.

    An element that only begins or ends like a skipped name goes if most of its text is links.
    """
    found, doubtful = [], []  # doubtful elements with text in or below them, the inner after the outer
    for element, text, fresh in pieces(html, wanted):
        if element.skip:
            continue
        found.append((element, text, fresh, element.link))
        d = element.doubt
        if d:
            chain, e = [], d
            while e and not e.seen:
                e.seen = True
                chain.append(e)
                e = e.parent.doubt
            doubtful.extend(reversed(chain))
            n = len(text.strip())
            d.length += n
            d.linked += n * element.link
    for d in reversed(doubtful):
        around = d.parent.doubt
        if around:
            around.length += d.length
            around.linked += d.linked
    for d in doubtful:
        around = d.parent.doubt
        d.gone = d.linked > LINKED * d.length or bool(around and around.gone)
        d.seen = False
    return [f for f in found if not (f[0].doubt and f[0].doubt.gone)]


def _container(best: _Element, order: list[_Element]) -> _Element:
    """The article or main element around the best container, or the lowest element with nearly all text and every h1."""
    e = best
    while e:
        if e.tag in ("article", "main"):
            return e
        e = e.parent
    for e in reversed(order):
        if e.parent:
            e.parent.total += e.total
            e.parent.title += e.title
    e = best
    while e.parent and (e.total < NEARLY * order[0].total or e.title < order[0].title):
        e = e.parent
    return e


def best_path(html: str) -> str:
    """Path of the page's own container; "" (the whole page) where no container has text."""
    holders: dict[int, _Element] = {}
    order: list[_Element] = []  # elements with text and those around them, the outer first
    for element, text, _, linked in _shown(html):
        weight = 0.0 if linked else float(len(text.strip()))
        if element.doubt:
            weight /= 2  # it may be no part of the article
        element.total += weight
        if element.block.tag == "h1":
            element.title += len(text)
        chain, e = [], element
        while e and not e.seen:
            e.seen = True
            chain.append(e)
            e = e.parent
        order.extend(reversed(chain))
        holder = element.holder
        if weight and holder is not None and holder.tag:
            holder.score += weight
            holders[id(holder)] = holder
            around = holder.parent.holder if holder.parent else None
            if around is not None and around.tag:
                around.score += weight / 2
                holders[id(around)] = around
    best = max(holders.values(), key=lambda h: h.score, default=None)  # of equals the first met
    return _container(best, order).path() if best else ""


def extract(html: str, paths: list[str]) -> str:
    """Text of the elements on the first of ``paths`` with more than a small share of the page's text.

    Where there is none: of the page's own container, if it is one of ``paths``, or encloses
    the first with text, or none has text; else of that first one.
    """
    found: dict[str, list[str]] = {}
    wanted, total = list(dict.fromkeys(paths)), 0
    for element, text, fresh, _ in _shown(html, wanted):
        total += len(text.strip())
        for path in element.within:
            found.setdefault(path, []).append(" " + text if fresh else text)
    texts = {p: " ".join("".join(found[p]).split()) for p in paths if p in found}
    texts = {p: joined for p, joined in texts.items() if joined}
    for joined in texts.values():
        if len(joined) > SMALL * total:
            return joined
    own = best_path(html)
    if own in wanted:
        return texts.get(own, "")
    first = next(iter(texts), None)
    if first is not None and not first.startswith(own + "/"):
        return texts[first]
    return extract(html, [own])


def host(url: Column) -> Column:
    """Lower-case host of a URL; "" where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _strings(column: pa.Array) -> list[str]:
    return [v or "" for v in column.to_pylist()]


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _slices(batch):
            paths = [best_path(h) for h in _strings(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(paths, pa.string())], names=["host", "path"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _slices(batch):
            texts = [extract(h, p or []) for h, p in zip(_strings(part.column(2)), part.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, paths): paths that at least ``VOTE_SHARE`` of the host's pages vote for, most votes first."""
    votes = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(_votes, "host string, path string")
    counted = durable.cut(votes.groupBy("host", "path").agg(F.count("*").alias("n")))  # read twice below
    totals = counted.groupBy("host").agg(F.sum("n").alias("total"))
    fair = counted.join(totals, "host").filter((F.col("n") >= VOTE_SHARE * F.col("total")) & (F.col("path") != ""))
    ranked = fair.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "path"))).alias("r"))
    return ranked.select("host", F.col("r.path").alias("paths"))


def main_text(pages: DataFrame) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    A null or empty html has an empty text. Pages without a host vote together. Repeated rows
    stay and vote each. Extra columns are ignored.
    """
    own = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    winners = durable.cut(winning_paths(pages))
    size = F.octet_length("host") + F.octet_length(F.array_join("paths", "")) + 64
    if (winners.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES:
        joined = own.join(F.broadcast(winners), "host", "left")
    else:
        salted = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        spread = own.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        joined = spread.join(salted, ["host", "salt"], "left")
    chosen = joined.select("page_id", "url", "html", "paths")
    page_type = pages.schema["page_id"].dataType.simpleString()
    return chosen.mapInArrow(_texts, f"page_id {page_type}, url string, text string, n_chars long")
