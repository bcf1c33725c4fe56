"""Main text of HTML pages: a template deduced per host from equivalence classes of tokens, and its slots."""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MOST_HOT, fresh, small_batches, written

#: An equivalence class needs so many pages and so many tokens.
LEAST_PAGES, LEAST_TOKENS = 4, 3
#: A text of a class that frames nothing is the template's if it is on such a share of the pages that have its element.
SHARE = 0.8
#: The article is in the innermost container of the template that holds such a share of its pages' text.
REGION = 0.95
#: A class of texts that make up more of their pages' text are copies of an article; a slot of which links are more is a list of links,
#: unless the rest of it is more than LISTED of its host's text: an article with many links.
COPY, LINKS, LISTED = 0.5, 0.5, 0.2
#: Templates' tokens in all, up to which the templates are broadcast (16 bytes each). Beyond, those of hosts of more than 1/MOST_HOT of all
#: pages still are (there are fewer than MOST_HOT), the others are joined.
MOST_BROADCAST = 500_000
#: Elements nested deeper are not told from the one around them; their text is.
DEPTH = 512

# `=` may start a quoted value; other quotes are part of a name. No part gives back what it has taken, so a tag is read once.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page, up to their end tag.
_RAW = {name: re.compile(rf"</{name}[\s/>]", re.I) for name in ("script", "style", "title", "textarea", "iframe", "noembed", "noframes")}
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_ENDS_P = _BLOCK - frozenset("body head html li td th tr tbody thead tfoot dd dt legend summary figcaption".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that can hold an article, and that are told apart by their places.
_CONTAINERS = frozenset("html body main article section div center td table ul ol blockquote".split())
#: An opening tag ends the element of one of these that is open, unless one of _HOLDS is open within.
_SAME = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_HOLDS = frozenset("ul ol dl table menu div".split())
#: Marks of regions that are never main text: elements, roles, and names of class or id all of whose words are known, one as a mark.
_OUT = frozenset("nav header footer aside form dialog button menu datalist select template".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices newsletter subscribe subscription signup login sidebar nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar share sharing social related recommended popup modal overlay paywall comment comments commentlist disqus respond replies reply discussion toolbar pagination pager menu search widget skip".split()
)
_NEUTRAL = frozenset("site page main top bottom left right box block list links link container wrapper wrap inner outer area section item items bar global primary secondary post posts article articles entry module region js thread form content text buttons button icons mobile desktop".split())
#: The name of an article's header, where no element says that it is in one.
_OWN_HEADER = re.compile(r"(?:entry|post|article)[-_]?header", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _marked(name: str) -> bool:
    """Whether a name of class or id says that its region is no main text: `cookie-notice` does, `form-of-government` does not."""
    words = [w for w in _PARTS.split(_CAMEL.sub(" ", name).lower()) if w and not w.isdigit()]
    return any(w in _MARKS for w in words) and all(w in _MARKS or w in _NEUTRAL for w in words)


class Element:
    __slots__ = ("name", "role", "out", "form", "article", "main", "header")

    def __init__(self, name: str, role: int, out: bool, form: bool, article: int, main: int, header: bool) -> None:
        self.name, self.role = name, role  # the role is a digest of the path of names and classes
        self.out = out  # within a region with marks
        self.form = form  # of which all are forms
        self.article, self.main = article, main  # the articles and main elements around
        self.header = header  # within the header of an article


OPEN, CLOSE, TEXT = 0, 1, 2
#: What happens in a page, in order: (kind, element, text, characters of the text in links).
Event = tuple[int, Element, str, int]


def _region(name: str, attributes: str) -> tuple[str, bool]:
    """The name that the element has in paths, and whether it has marks."""
    if not attributes or attributes.isspace() or attributes == "/":
        return name, name in _OUT
    named = {k.lower(): unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    own = f"{named.get('class', '')} {named.get('id', '')}".split()
    out = name in _OUT or named.get("role", "").lower() in _ROLES or "hidden" in named or named.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(named.get("style", "")))
    if name not in ("main", "body", "html") and name not in _HEADING:
        out = out or any(map(_marked, own))
    return f"{name}.{_DIGITS.sub('0', ' '.join(own))}" if own and name in _BLOCK and name not in ("html", "body") else name, out


def events(html: str | None) -> list[Event]:
    """The elements and blocks of text of a page, in one pass over it; end tags that nothing opened are skipped and missing ones implied."""
    html = html or ""
    out: list[Event] = []
    stack = [Element("", 0, False, False, 0, 0, False)]
    open_names: Counter[str] = Counter()
    deeper: Counter[str] = Counter()  # elements beyond DEPTH
    run: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            out.append((TEXT, stack[-1], text, min(linked, len(text))))
        linked = 0

    def pop() -> None:
        e = stack.pop()
        open_names[e.name] -= 1
        out.append((CLOSE, e, "", 0))

    def close(name: str) -> None:
        if deeper[name]:
            deeper[name] -= 1
        elif open_names[name] > 0:
            while stack[-1].name != name:
                pop()
            pop()

    def push(name: str, label: str, marked: bool) -> None:
        up = stack[-1]
        if len(stack) > DEPTH:
            deeper[name] += 1
            return
        own = "header" in label and (up.article + up.main > 0 or bool(_OWN_HEADER.search(label)))
        header = up.header or own
        marked = marked and not own
        region, form = up.out, False
        if region:
            form = up.form and not marked
            if up.form and (name == "article" or name == "main"):
                region = form = False  # a form that holds an article is the page's, not a form to fill in
        elif marked:
            form = name == "form"
        stack.append(Element(name, _digest(f"{up.role}/{label}"), region or marked, form, up.article + (name == "article"), up.main + (name == "main"), header))
        open_names[name] += 1
        out.append((OPEN, stack[-1], "", 0))

    def words(text: str) -> None:
        nonlocal linked
        run.append(unescape(text))
        if links:
            linked += len(text)

    at, tag, unclosed, end_of, last = 0, _TAG, set(), len(html), html.rfind(">")
    while (lt := html.find("<", at)) >= 0:
        follows = html[lt + 1 : lt + 2]
        if follows in ("!", "?"):
            words(html[at:lt])
            stop = html.find("-->", lt + 4) + 2 if html.startswith("<!--", lt) else html.find(">", lt)
            at = stop + 1 if stop > lt else end_of
            continue
        m = tag.match(html, lt)
        if m is None and tag is _TAG and (follows.isalpha() or follows == "/"):
            tag = _PLAIN  # a quote that is never closed: from here on quotes do not count, so that no tag is tried twice
            m = tag.match(html, lt)
        if m is None:
            if follows.isascii() and follows.isalpha() and last < lt:
                words(html[at:lt])  # an unfinished tag at the end
                at = end_of
                break
            if follows == "/" and last > lt:
                words(html[at:lt])  # an end tag without a name
                at = html.find(">", lt) + 1
                continue
            words(html[at : lt + 1])  # a sign, no tag
            at = lt + 1
            continue
        words(html[at:lt])
        at = m.end()
        end, name, attributes = m[1], m[2].lower(), m[3]
        if name in _RAW:
            if not end and not attributes.endswith("/") and name not in unclosed:
                if found := _RAW[name].search(html, at):
                    stop = html.find(">", found.start())
                    at = stop + 1 if stop >= 0 else end_of
                elif name in ("script", "style"):
                    at = end_of
                else:
                    unclosed.add(name)
            continue
        if name == "br":
            run.append(" ")
            continue
        if name == "a":
            links = 0 if end else 1
        if name not in _BLOCK:
            if end:
                if open_names[name] > 0 or deeper[name]:
                    flush()
                    close(name)
            elif name not in _VOID and (attributes or name in _OUT) and _region(name, attributes)[1] and not attributes.endswith("/"):
                flush()
                push(name, name, True)
            continue
        flush()
        links = 0
        if end:
            close(name)
            continue
        if name in _ENDS_P and stack[-1].name == "p":
            pop()
        same = _SAME.get(name, ())
        if any(open_names[s] > 0 for s in same):
            k = len(stack) - 1
            while k > 0 and stack[k].name not in same and stack[k].name not in _HOLDS:
                k -= 1
            if k > 0 and stack[k].name in same:
                while len(stack) > k:
                    pop()
        if name != "hr":
            push(name, *_region(name, attributes))
    words(html[at:])
    flush()
    while len(stack) > 1:
        pop()
    return out


def tokens(html: str | None) -> Counter:
    """(token, the element it stands in, whether it is a text, whether it frames articles) -> how often the page has it.

    A token is an element by its role, or a block of text by its words and its element's role. Elements frame, and texts in regions with marks."""
    out: Counter = Counter()
    above = [0]
    for kind, e, text, _ in events(html):
        if kind == OPEN:
            out[e.role, above[-1], False, True] += 1
            above.append(e.role)
        elif kind == CLOSE:
            above.pop()
        else:
            out[_digest(f"{e.role}\0{text}"), e.role, True, e.out] += 1
    return out


@dataclass
class Template:
    """A host's template. tokens: token -> the number of its class, of tokens that a page has once; repeated: elements that each page has
    equally often, which are told apart by their places; texts: those tokens that are fixed texts; regions: elements that hold
    most of their pages' text; lists: the tokens after which a slot holds mostly links."""

    tokens: dict[int, int] = field(default_factory=dict)
    repeated: set[int] = field(default_factory=set)
    texts: set[int] = field(default_factory=set)
    regions: set[int] = field(default_factory=set)
    lists: set[int] = field(default_factory=set)


@dataclass
class Block:
    text: str
    linked: int
    element: Element
    slot: int  # the last token of the template before it, which names the slot
    token: int  # its own token, if that is one of the template's
    at: int  # its place among the events


@dataclass
class Page:
    """A page held against a template."""

    blocks: list[Block] = field(default_factory=list)
    within: list[tuple[int, int, int, int]] = field(default_factory=list)  # (token, first and last event, characters) of the template's containers
    articles: list[tuple[int, int]] = field(default_factory=list)  # first and last event of the articles, inner ones first
    order: dict[int, int] = field(default_factory=dict)  # class -> a digest of the order of its tokens and of what is around them


def matched(html: str | None, template: Template) -> Page:
    """Deals the blocks of a page to the slots between the template's tokens. Texts in regions with marks or in links do not count as characters."""
    page, slot, chars, places = Page(), 0, 0, Counter()
    around: list[tuple[int, int, int, int]] = []  # (token or 0, the token of the template around, first event, characters before)
    inner = 0
    for at, (kind, e, text, linked) in enumerate(events(html)):
        if kind == OPEN:
            token = e.role if e.role in template.tokens else 0
            if e.role in template.repeated and e.name in _CONTAINERS:
                places[e.role] += 1
                token = _digest(f"{e.role} {places[e.role]}")
            around.append((token, inner, at, chars))
            if token:
                if (c := template.tokens.get(token)) is not None:
                    page.order[c] = _digest(f"{page.order.get(c, 0)} {inner} {token}")
                slot = inner = token
        elif kind == CLOSE:
            token, outer, first, before = around.pop()
            if token:
                slot, inner = _digest(f"{token} end"), outer
                if e.name in _CONTAINERS:
                    page.within.append((token, first, at, chars - before))
            if e.name == "article" and not e.out:
                page.articles.append((first, at))
        else:
            token = _digest(f"{e.role}\0{text}")
            if (c := template.tokens.get(token)) is not None:
                page.order[c] = _digest(f"{page.order.get(c, 0)} {inner} {token}")
                page.blocks.append(Block(text, linked, e, slot, token, at))
                slot = token
            else:
                page.blocks.append(Block(text, linked, e, slot, 0, at))
            if not e.out:
                chars += len(text) - linked
    return page


def main_text(html: str | None, template: Template) -> str:
    """The blocks of the article, a line each.

    The article is in the innermost container of the template that holds the text, or in the whole page where the template names none.
    The template's own texts go, and so do slots that hold lists of links and regions with marks, but for headings in an
    article's header. Within article and main elements what stands in each article of a site between other text, such as its headings, is
    the article's, and so are up to LEAST_TOKENS - 1 such blocks at its begin or end; more of them there are notices. An article element around the container, or else those within, then main elements, are the text. A title that stands
    before the container belongs to it.
    """
    page = matched(html, template)
    own = [b for b in page.blocks if not b.element.out and (not b.element.header or b.element.name in _HEADING)]
    fixed = lambda b: b.token in template.texts or b.slot in template.lists and b.element.name not in _HEADING
    inner = [b for b in own if b.element.article or b.element.main] if template.texts or template.lists else []
    notices = {id(b) for side in (inner, inner[::-1]) if len(run := list(itertools.takewhile(fixed, side))) >= LEAST_TOKENS for b in run}
    kept = [b for b in own if not (id(b) in notices if b.element.article or b.element.main else fixed(b))]
    holders = [w for w in page.within if w[0] in template.regions]
    if holders:
        _, first, last, _ = max(holders, key=lambda w: w[1])
        first, last = next(((a, z) for a, z in page.articles if a <= first and last <= z), (first, last))
        inside = [b for b in kept if first < b.at < last]
        if inside:
            title = [] if any(b.element.name == "h1" for b in inside) else [b for b in kept if b.at < first and b.element.name == "h1"]
            kept = title + inside
    for part in ([b for b in kept if b.element.article], [b for b in kept if b.element.main]):
        if part:
            return "\n".join(b.text for b in part)
    return "\n".join(b.text for b in kept)


def _host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


_ARRAYS = ("tokens", "classes", "repeated", "texts", "regions", "lists")


def _template(row: dict) -> Template:
    """A template of a row's arrays; nulls are empty."""
    have = {k: [] if row.get(k) is None else [int(x) for x in row[k]] for k in _ARRAYS}
    return Template(dict(zip(have["tokens"], have["classes"], strict=True)), *[set(have[k]) for k in _ARRAYS[2:]])


def _with_templates(pages: DataFrame, found: DataFrame, host: str, names: dict[str, str]) -> DataFrame:
    """pages with the arrays of their host's template; `_ARRAYS` that found lacks are not there.

    found has a row for each host of LEAST_PAGES pages. Small templates are broadcast. Otherwise those of hosts with a large part of all
    pages are (fewer than MOST_HOT of them), and only pages of other hosts are shuffled by their host, of which none is large.
    """
    own = found.select(F.col("host").alias(host), "n", *[F.col(k).alias(v) for k, v in names.items()])
    size, every = own.agg(F.sum(sum((F.size(v) for v in names.values()), F.lit(8))), F.sum("n")).first()
    if (size or 0) <= MOST_BROADCAST:
        return pages.join(F.broadcast(own.drop("n")), host, "left")
    large = F.col("n") > every / MOST_HOT
    hot, rest = own.where(large).drop("n"), own.where(~large).drop("n")
    least = pages.where(F.col(host) == "")
    others = pages.where(F.col(host) != "").join(F.broadcast(hot.select(host)), host, "left_anti").join(rest, host, "left")
    return pages.join(F.broadcast(hot), host).unionByName(others).unionByName(least, allowMissingColumns=True)


def _keyed(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    own = pages.select(_host(F.col(f"`{url_col}`")).alias("host"), F.xxhash64(F.coalesce(F.col(f"`{html_col}`"), F.lit(""))).alias("page"), F.col(f"`{html_col}`").alias("html"))
    return own.where("host <> '' and html is not null")


def classes(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """pages -> (host, n, tokens, classes, repeated): for each host of LEAST_PAGES pages the tokens of its valid equivalence classes.

    A token's occurrence vector is how often each page of the host has it. Tokens with equal vectors form a class; the vector is compared
    by its sum over pages of a hash of page and count, which Spark sums before and after the shuffle, so that a host with a third
    of all pages is no task's work. A class is valid with LEAST_TOKENS tokens on LEAST_PAGES pages, whatever share of the host
    that is, so each layout of a host has its own. Tokens that a page has once are the template's; of elements that
    each page has equally often the first, second and so on are. Classes that frame nothing are what articles quote; their texts
    are the template's only if they are on SHARE of the pages that have their element.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, page, html in zip(batch["host"], batch["page"], batch["html"], strict=True):
                rows += [(host, page, *key, n) for key, n in tokens(html).items()]
                rows.append((host, page, 0, 0, False, False, 0))
            yield pd.DataFrame(rows, columns=["host", "page", "token", "parent", "text", "frame", "n"])

    seen = _keyed(pages, url_col, html_col).mapInPandas(read, "host string, page long, token long, parent long, text boolean, frame boolean, n long")
    hashed = F.xxhash64("page", "n").cast("decimal(38,0)")
    counted = seen.groupBy("host", "token", "parent", "text", "frame").agg(F.sum(hashed).alias("vector"), F.count(F.lit(1)).alias("pages"), F.min("n").alias("least"), F.max("n").alias("most"))
    frequent = written(counted.where(f"pages >= {LEAST_PAGES}"), "tokens")
    hosts = frequent.where("token = 0 and parent = 0").select("host", F.col("pages").alias("n"))
    frequent = frequent.where("token <> 0 or parent <> 0")
    valid = frequent.groupBy("host", "vector").agg(F.count(F.lit(1)).alias("size"), F.bool_or("frame").alias("framed")).where(f"size >= {LEAST_TOKENS}")
    outer = frequent.where("not text").groupBy("host", F.col("token").alias("parent")).agg(F.max("pages").alias("of"))
    own = frequent.where("least = most").join(valid, ["host", "vector"]).join(outer, ["host", "parent"], "left")
    own = own.where(~F.col("text") | (F.col("least") == 1) & (F.col("framed") | (F.col("pages") >= SHARE * F.col("of"))))
    once = F.col("least") == 1
    # One struct for both arrays, so that tokens and classes stay side by side.
    pair = F.collect_list(F.when(once, F.struct("token", F.xxhash64("vector").alias("class"))))
    made = own.groupBy("host").agg(pair.alias("pair"), F.collect_set(F.when(~once, F.col("token"))).alias("repeated"))
    return hosts.join(made, "host", "left").select("host", "n", F.col("pair.token").alias("tokens"), F.col("pair.class").alias("classes"), "repeated")


def templates(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """pages -> (host, n, tokens, classes, repeated, texts, regions, lists): each host's template, see Template.

    The pages are held against the classes. Classes whose tokens are not in the same order and nested in the same elements on all their
    pages go. For the others Spark sums over the host's pages how much of the text is in each element, in each slot and
    in each class of texts, which says where the article is. A class of texts that are most of their pages is not
    what frames articles, but an article of which there are copies.
    """
    found = written(classes(pages, url_col=url_col, html_col=html_col), "classes")
    names = {k: k for k in ("tokens", "classes", "repeated")}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums: dict[tuple[str, str, int], list[int]] = {}
            known: dict[str, Template] = {}

            def add(host: str, kind: str, key: int, a: int, b: int, sums: dict = sums) -> None:
                have = sums.setdefault((host, kind, key), [0, 0])
                have[0] += a
                have[1] += b

            orders: dict[tuple[str, int], list[int]] = {}
            for row in batch.to_dict("records"):
                host = row["host"]
                if host not in known:
                    known[host] = _template(row)
                template = known[host]
                page = matched(row["html"], template)
                counted = [b for b in page.blocks if not b.element.out]
                total = sum(len(b.text) - b.linked for b in counted)
                for token, _, _, chars in page.within:
                    add(host, "region", token, chars, total)
                fixed: Counter = Counter()
                for b in counted:
                    add(host, "slot", b.slot, len(b.text) - b.linked, b.linked)
                    if b.token:
                        fixed[template.tokens[b.token]] += len(b.text) - b.linked
                for c, chars in fixed.items():
                    add(host, "class", c, chars, total)
                for c, order in page.order.items():
                    have = orders.setdefault((host, c), [order, order])
                    have[:] = min(have[0], order), max(have[1], order)
            rows = [(h, k, key, a, b, None, None) for (h, k, key), (a, b) in sums.items()] + [(h, "order", key, 0, 0, a, b) for (h, key), (a, b) in orders.items()]
            frame = pd.DataFrame(rows, columns=["host", "kind", "key", "a", "b", "low", "high"])
            yield frame.astype({"key": "int64", "a": "int64", "b": "int64"}).assign(low=pd.array(frame["low"].tolist(), dtype="Int64"), high=pd.array(frame["high"].tolist(), dtype="Int64"))

    own = _with_templates(_keyed(pages, url_col, html_col), found, "host", names)
    seen = own.where("tokens is not null").mapInPandas(read, "host string, kind string, key long, a long, b long, low long, high long")
    # Written, as it is used twice: each time the pages would be parsed.
    summed = written(seen.groupBy("host", "kind", "key").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.min("low").alias("low"), F.max("high").alias("high")), "sums")
    keys = lambda kind, test: F.collect_set(F.when((F.col("kind") == kind) & test, F.col("key")))
    a, b = F.col("a"), F.col("b")
    every = summed.where("kind = 'slot'").groupBy("host").agg(F.sum("a").alias("every"))
    listed = (b > LINKS * (a + b)) & (a <= LISTED * F.col("every"))
    judged = summed.join(every, "host", "left").groupBy("host").agg(
        keys("region", (b > 0) & (a >= REGION * b)).alias("regions"), keys("slot", listed).alias("lists"), keys("class", a > COPY * b).alias("copies"), keys("order", F.col("low") != F.col("high")).alias("unordered")
    )
    # What is not in order is no token; what is a copy is one, but its texts stay.
    at = F.arrays_zip("tokens", "classes")
    ordered = F.filter(at, lambda x: ~F.array_contains("unordered", x["classes"]))
    fixed = F.filter(ordered, lambda x: ~F.array_contains("copies", x["classes"]))
    none = F.array().cast("array<long>")
    joined = found.join(judged, "host", "left").withColumns({k: F.coalesce(F.col(k), none) for k in ("tokens", "classes", "repeated", "regions", "lists", "copies", "unordered")})
    parts = joined.select("host", "n", ordered.alias("ordered"), "repeated", fixed.alias("fixed"), "regions", "lists")
    return parts.select("host", "n", F.col("ordered.tokens").alias("tokens"), F.col("ordered.classes").alias("classes"), "repeated", F.col("fixed.tokens").alias("texts"), "regions", "lists")


def extract(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Adds text and n_chars (code points) to every row; columns of pages with these names are replaced.

    Pages of hosts without a template (few pages, no URL) are read by their elements alone. Null and empty html give an empty text; a page
    without tags is its text; repeated rows give equal texts; an empty table gives no rows. Pages of any length and nesting are read in one
    pass: elements deeper than DEPTH count as the one around them, tags that are never closed end with the page.
    """
    pages = small_batches(pages).drop("text", "n_chars")
    host, got = fresh(pages, "host_of"), fresh(pages, "got")
    found = written(templates(pages, url_col=url_col, html_col=html_col), "templates")
    names = {k: fresh(pages, f"{k}_of") for k in _ARRAYS}
    joined = _with_templates(pages.withColumn(host, _host(F.col(f"`{url_col}`"))), found, host, names)

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for html, hosts, *arrays in batches:
            known: dict[str, Template] = {}
            out = []
            for h, name, *values in zip(html, hosts, *arrays, strict=True):
                if name not in known:
                    known[name] = _template(dict(zip(_ARRAYS, values, strict=True)))
                out.append(main_text(h, known[name]))
            yield pd.Series(out, dtype=object)

    out = joined.withColumn(got, F.pandas_udf(run, "string")(F.col(f"`{html_col}`"), F.col(host), *[F.col(names[k]) for k in _ARRAYS]))
    return out.select(*[F.col(f"`{c}`") for c in pages.columns], F.col(got).alias("text"), F.char_length(got).cast("long").alias("n_chars"))
