"""Main text of web pages by wrappers: union-free regular expressions inferred per template of a host.

A page is parsed into its element tree; runs of equal siblings become repeated groups.  Pages of a host
that hold their text in the same place (the same elements around most of it) share a template.  They are
aligned: what all have stays, what only some have becomes optional, neighbours that turn out equal become
repeated, and texts that differ become slots.  Texts that are the same on all pages stay as such.

A page is then walked along its template's expression.  A text outside article elements that the
expression has as the same on all pages is the host's and not the article's, if the template has slots
for other texts and the page's texts there are long enough: one of n pages that share a text weighs its
own by n - 1.  Lists of links are menus.  Texts below menus, headers, footers, side bars, notices,
adverts, forms or reader comments are not the article, unless the element that says so holds the article
or most of the page's text.  If a page has any other text in an article element, only such text counts,
else all that is left.

Scale: pages are aligned in rounds, in groups that their contents alone decide, so that neither the
number of tasks nor the order of rows matters and a host with a third of all pages is many groups.  Parts
that one page only has decide nothing and leave the expression, which so has the size of a template.
"""

from __future__ import annotations

import difflib
import hashlib
import html as entities
import json
import re
import sys
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import Scratch, forget, stored
from ledgerlake.llm.urls import host_path

# HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead tr ul".split())
#: An element that ends an open one of the same group, up to the group's container.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}
#: Elements that are not the article, and class, id or role words that say the same.
OUTSIDE = frozenset("aside button dialog footer form head header label menu nav option select".split())
OUTSIDE_WORDS = frozenset(
    "ad ads adsense adslot advert adverts advertisement advertising advertorial alert alerts banner banners breadcrumb breadcrumbs "
    "byline caption comment comments commentlist complementary consent contentinfo cookie cookies copyright dialog discussion disqus "
    "dropdown footer footnav form gdpr header hidden legal links login masthead menu menus modal nav navbar navigation newsletter "
    "notice notices notification overlay pager pagination popup promo promos promoted promotion recommended recommendations related "
    "replies reply respond responses rail search share sharing shares sidebar sidebars signup skip social sponsor sponsored sponsors "
    "subscribe subscription tags teaser toolbar topbar widget widgets".split())
#: Words that name a kind of text and not a place; they hold however much of the page it is.
COMMENT_WORDS = frozenset("comment comments commentlist discussion disqus replies reply respond responds".split())
#: Words that only say where or how, as in site-header, sidebar-left or ad-box.
PLACE_WORDS = frozenset(
    "area bar block body bottom box button buttons col column container content fixed global group icons inner item items left list "
    "main mobile outer page panel post primary right row secondary section single site small sticky text title top wide wrap wrapper".split())
#: Elements that texts are made of; a template is named by the elements above these.
TEXTUAL = frozenset("blockquote dd dl dt figure h1 h2 h3 h4 h5 h6 li ol p pre table ul".split())
#: Wrappers that one task aligns at a time.
FAN = 64

# trees may be as deep as their pages; the functions below call themselves in Python only
sys.setrecursionlimit(max(sys.getrecursionlimit(), 10_000_000))

TOKEN = re.compile(
    r"<(/?+)([a-zA-Z][^\s/>]*+)(?:((?:\"[^\"]*+\"|'[^']*+'|[^\"'>])*+)>|([^>]*+)>)"
    r"|<!--.*?(?:-->|\Z)|<[!?/][^>]*+>", re.S)
#: Elements without article text, skipped up to their end tag.  Without one, raw text goes on to the end
#: of the page; of the others only the tag is skipped.
SKIPPED = {name: re.compile(rf"</{name}\s*>", re.I) for name in
           "script style textarea title noscript template iframe svg math object xmp".split()}
RAW_TEXT = frozenset("script style title textarea xmp iframe".split())
#: Skipped elements that may be closed by their own tag; a sign after an unquoted value is part of the value.
SELF_CLOSED = frozenset("svg math object iframe".split())
UNQUOTED_END = re.compile(r"=\s*[^\s\"'>]+/\Z")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)
NOT_WORD = re.compile(r"[^a-z0-9]+")


P, NONE = frozenset(["p"]), frozenset()


class Element:
    """``key`` is the tag name with what its class, id and role say; children are elements and texts;
    ``weight`` is set by ``_weigh``."""

    __slots__ = ("name", "key", "children", "weight")

    def __init__(self, name: str, key: str):
        self.name, self.key, self.children, self.weight = name, key, [], 0


def _key(name: str, attributes: str) -> str:
    if "=" not in attributes and not HIDDEN.search(attributes):
        return name
    words = []
    for at, value in ATTRIBUTE.findall(attributes):
        if at.lower() in ("class", "id", "role", "itemprop"):
            words += ["-".join(w for w in NOT_WORD.split(token) if w and not w.isdigit()) for token in value.strip("\"'").lower().split()]
    words = [w for w in words if w]
    if HIDDEN.search(attributes):
        words.append("hidden")
    return ".".join([name, *dict.fromkeys(words)])


def parse(page: str) -> Element:
    """The element tree; forgiving like a browser: unclosed and stray tags are settled, comments, scripts
    and styles are left out."""
    root = Element("", "")
    stack, opened = [root], [""]  # open elements, and their names
    many: Counter[str] = Counter()  # open elements of each name

    def leave(k: int) -> None:
        many.subtract(opened[k:])
        del stack[k:], opened[k:]

    def close(names: set[str] | frozenset[str], stop: set[str] | frozenset[str]) -> None:
        if not any(map(many.__getitem__, names)):
            return
        for k in range(len(stack) - 1, 0, -1):
            if opened[k] in names:
                leave(k)
                return
            if opened[k] in stop:
                return

    at, search = 0, TOKEN.search
    unclosed: set[str] = set()  # skipped elements that have no end tag from here on
    while m := search(page, at):
        start = m.start()
        if start > at:
            stack[-1].children.append(page[at:start])
        at = m.end()
        shut, name, attributes, odd = m.groups()
        if not name:
            continue
        name = name.lower()
        if shut:
            if opened[-1] == name:
                leave(len(stack) - 1)
            else:
                close({name}, NONE if name in BLOCK and name != "p" else BLOCK)
            continue
        if name in SKIPPED:
            signs = attributes or odd or ""
            if name in SELF_CLOSED and signs.endswith("/") and not UNQUOTED_END.search(signs):
                continue
            end = None if name in unclosed else SKIPPED[name].search(page, at)
            if end:
                at = end.end()
            elif name in RAW_TEXT:
                at = len(page)
            else:
                unclosed.add(name)
            continue
        if name in SIBLINGS:
            names, box = SIBLINGS[name]
            close(names, box)
        if many["p"] and name in BLOCK:
            close(P, BLOCK)
        attributes = attributes or odd or ""
        element = Element(name, _key(name, attributes) if attributes else name)
        stack[-1].children.append(element)
        if name not in VOID and not attributes.endswith("/"):
            stack.append(element)
            opened.append(name)
            many[name] += 1
    if at < len(page):
        stack[-1].children.append(page[at:])
    return root


# A wrapper is a list of items.  An item is a dict: "k" key of an element or "#" for text; "c" the
# element's items; "t" digest of a text that is always the same; "o" optional; "r" repeated; "m" found on
# more than one page.


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).hexdigest()


def _items(element: Element) -> list[dict]:
    out: list[dict] = []
    for child in element.children:
        if isinstance(child, str):
            if not child.isspace():
                out.append({"k": "#", "t": _digest(child)})
        elif child.name not in ("br", "wbr"):
            out.append({"k": child.key, "c": _items(child)})
    return _repeats(out)


def _merge_item(a: dict, b: dict, one_page: bool = False) -> dict:
    out = {"k": a["k"]}
    if "c" in a:
        out["c"] = align(a["c"], b["c"], one_page)
    elif "t" in a and "t" in b and a["t"] == b["t"]:
        out["t"] = a["t"]
    for sign in "orm":
        if sign in a or sign in b:
            out[sign] = 1
    if not one_page:
        out["m"] = 1
    return out


def _repeats(items: list[dict]) -> list[dict]:
    """Runs of neighbours with the same key, or of pairs of keys, become one repeated item each."""
    for width in (1, 2):
        if len(items) < 2 * width:
            break
        out: list[dict] = []
        for item in items:
            out.append(item)
            while len(out) >= 2 * width and [x["k"] for x in out[-width:]] == [x["k"] for x in out[-2 * width:-width]]:
                last = out[-width:]
                del out[-width:]
                out[-width:] = [{**_merge_item(x, y, True), "r": 1} for x, y in zip(out[-width:], last)]
        items = out
    return items


_KNOWN: dict[tuple, list[tuple]] = {}


def _differences(a: tuple[str, ...], b: tuple[str, ...]) -> list[tuple]:
    """Edit steps between two key lists; lists recur, so some are remembered."""
    if (a, b) not in _KNOWN:
        if len(_KNOWN) > 4096:
            _KNOWN.clear()
        _KNOWN[a, b] = difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
    return _KNOWN[a, b]


def align(a: list[dict], b: list[dict], one_page: bool = False) -> list[dict]:
    """Union-free alignment of two item lists, of two pages or of two places of one page."""
    ka, kb = [x["k"] for x in a], [x["k"] for x in b]
    if ka == kb:
        return [_merge_item(x, y, one_page) for x, y in zip(a, b)]
    out: list[dict] = []
    for kind, i, j, k, m in _differences(tuple(ka), tuple(kb)):
        if kind == "equal":
            out += [_merge_item(x, y, one_page) for x, y in zip(a[i:j], b[k:m])]
        else:
            out += [{**x, "o": 1} for x in a[i:j]] + [{**x, "o": 1} for x in b[k:m]]
    return _repeats(out)


def _common(items: list[dict]) -> list[dict]:
    """A wrapper without optional elements that one page only has, but for those that stand beside an
    element of the same key: they tell that its text is not the only one there."""
    kept = {x["k"] for x in items if "o" not in x or "m" in x}
    return [{**x, "c": _common(x["c"])} if "c" in x else x for x in items if x["k"] == "#" or x["k"] in kept]


def to_text(items: list[dict]) -> str:
    """A wrapper as JSON: its items in page order, each with its depth."""
    out: list[list] = []

    def visit(items: list[dict], depth: int) -> None:
        for x in items:
            out.append([depth, x["k"], "".join(k for k in "orm" if k in x), *([x["t"]] if "t" in x else [])])
            if "c" in x:
                visit(x["c"], depth + 1)

    visit(items, 0)
    return json.dumps(out, separators=(",", ":"))


def from_text(text: str) -> list[dict]:
    levels: list[list[dict]] = [[]]
    for depth, key, signs, *same in json.loads(text):
        item = {"k": key, **dict.fromkeys(signs, 1)}
        if same:
            item["t"] = same[0]
        del levels[depth + 1:]
        levels[depth].append(item)
        if key != "#":
            item["c"] = []
            levels.append(item["c"])
    return levels[0]


def expression(items: list[dict]) -> str:
    """A wrapper as a regular expression over tags, with # for slots."""
    out = []
    for x in items:
        body = (f"\"{x['t']}\"" if x.get("t") else "#") if x["k"] == "#" else f"<{x['k']}>{expression(x['c'])}</{x['k'].split('.')[0]}>"
        sign = "*" if x.get("o") and x.get("r") else "?" if x.get("o") else "+" if x.get("r") else ""
        out.append(f"({body}){sign}" if sign else body)
    return "".join(out)


@lru_cache(100_000)
def _outside_words(key: str) -> frozenset[str]:
    """The outside words of a key.  A class, id or role counts as a whole: all its parts must be such
    words or say a place, so site-header counts and has-sidebar or overflow-hidden do not."""
    name, *tokens = key.split(".")
    if name in ("html", "body"):
        return NONE
    parts = [token.split("-") for token in tokens]
    return frozenset(w for p in parts if all(w in OUTSIDE_WORDS or w in PLACE_WORDS for w in p) for w in p if w in OUTSIDE_WORDS)


@lru_cache(100_000)
def _is_article(key: str) -> bool:
    name, *tokens = key.split(".")
    return name in ("article", "main") or "articlebody" in tokens or any(
        "main" in t.split("-") and not OUTSIDE_WORDS.intersection(t.split("-")) for t in tokens)


@lru_cache(100_000)
def _signs(key: str) -> tuple[bool, bool, bool, bool]:
    """Whether an element is none of the article's, is an article, a plain link, a list entry."""
    name = key.split(".")[0]
    return name in OUTSIDE, _is_article(key), key == "a", name == "li"


class Place:
    """Where a walk along a page and its wrapper is: what the elements above say, and the wrapper's node,
    None where the page has a part that the wrapper lacks."""

    __slots__ = ("lost", "article", "link", "entry", "node")

    def __init__(self, lost: bool, article: bool, link: bool, entry: bool, node: dict | None):
        self.lost, self.article, self.link, self.entry, self.node = lost, article, link, entry, node

    def below(self, key: str) -> Place:
        lost, article, link, entry = _signs(key)
        return Place(self.lost or lost, self.article or article, self.link or link, self.entry or entry,
                     self.node.get(key) if self.node else None)

    @property
    def slot(self) -> bool:
        """Whether texts may be the article's; lists of links outside article elements are menus."""
        return not self.lost and (self.article or not (self.link and self.entry))

    def same(self, text: str) -> bool:
        """Whether the wrapper has this text here, and no other."""
        texts = self.node.get("#", ()) if self.node else ()
        return len(texts) == 1 and not self.article and _digest(text) in texts


class Wrapper:
    """An expression to walk along: ``tree`` has the texts of each place (None for one that differs or
    that some page lacks); ``changes``: it has a place for other texts that no outside word is about."""

    def __init__(self, items: list[dict], pages: int):
        self.tree, self.pages, self.changes = {}, pages, False

        def grow(items: list[dict], node: dict, sure: bool) -> None:
            for x in items:
                here = sure and "o" not in x
                if x["k"] == "#":
                    node.setdefault("#", set()).add(x.get("t") if here else None)
                else:
                    grow(x["c"], node.setdefault(x["k"], {}), here)

        def look(place: Place) -> None:
            for key, value in place.node.items():
                if key == "#":
                    self.changes |= place.slot and not place.article and (len(value) > 1 or None in value)
                elif not _outside_words(key):
                    look(place.below(key))

        grow(items, self.tree, True)
        look(self.start())

    def start(self) -> Place:
        return Place(False, False, False, False, self.tree)

    def constants(self) -> set[tuple[str, ...]]:
        """Paths of the texts that are the same on all pages."""
        found = set()

        def visit(node: dict, path: tuple[str, ...]) -> None:
            for key, value in node.items():
                if key != "#":
                    visit(value, (*path, key))
                elif len(value) == 1 and None not in value:
                    found.add(path)

        visit(self.tree, ())
        return found


def _weigh(element: Element) -> int:
    """Set the weight of an element and of all below: characters of text that is not below a menu, a
    header, a form or the like."""
    element.weight = 0
    if element.name not in OUTSIDE:
        for c in element.children:
            element.weight += len(c.strip()) if isinstance(c, str) else _weigh(c)
    return element.weight


def template(root: Element) -> str:
    """The elements around most of a page's text, from the outermost one on."""
    _weigh(root)
    keys, here = [], root
    while here:
        here = max((c for c in here.children if not isinstance(c, str)), key=lambda c: c.weight, default=None)
        if here is None or 2 * here.weight <= root.weight or here.name in TEXTUAL:
            break
        keys.append(here.key)
    return _digest(" ".join(keys))


def _outside(root: Element, wrapper: Wrapper, kept: frozenset[str]) -> tuple[set[int], bool, bool]:
    """Ids of the page's elements whose words put them outside the article; whether the page has text in
    an article element; whether texts that all pages have are not the article's.  An element with most
    of the page's text is not outside, unless by a word in ``kept``, and neither is the page's only
    sizeable article or what it lies in."""
    out: set[int] = set()
    best: tuple[int, tuple | None] = (0, None)  # the heaviest article outside: weight, ids of it and of what it lies in
    weight = {"article": 0, "own": 0, "same": 0}  # of the texts that are left

    def visit(element: Element, place: Place, above: tuple | None, hidden: bool) -> None:
        nonlocal best
        for child in element.children:
            if isinstance(child, str):
                if not hidden and place.slot:
                    weight["article" if place.article else "same" if place.same(child) else "own"] += len(child.strip())
                continue
            if not child.weight:
                continue
            words, here = _outside_words(child.key), (id(child), above)
            if words and (2 * child.weight <= root.weight or words & kept):
                out.add(id(child))
            lost = hidden or id(child) in out
            if lost and child.weight > best[0] and _is_article(child.key):
                best = child.weight, here
            visit(child, place.below(child.key), here, lost)

    visit(root, wrapper.start(), None, False)
    hosts = wrapper.changes and (weight["own"] + 1) * (wrapper.pages - 1) >= weight["same"]
    if not weight["article"] and best[0] > weight["own"] + (0 if hosts else weight["same"]):
        ids = best[1]
        while ids:
            out.discard(ids[0])
            ids = ids[1]
        return out, True, hosts
    return out, weight["article"] > 0, hosts


def main_text(page: str, wrapper: Wrapper) -> str:
    """The page's texts, one line a block: those in article elements if the page has any, else the
    others without those that are the host's."""
    root = parse(page)
    _weigh(root)
    blocks: list[list[str]] = [[]]

    def visit(element: Element, place: Place, out: set[int], article: bool, hosts: bool) -> None:
        for child in element.children:
            if isinstance(child, str):
                if place.slot and place.article == article and not (hosts and place.same(child)):
                    blocks[-1].append(entities.unescape(child))
                continue
            if child.name in ("br", "wbr"):
                blocks[-1].append(" " if child.name == "br" else "")
                continue
            if id(child) in out:
                continue
            edge = child.name in BLOCK
            if edge:
                blocks.append([])
            visit(child, place.below(child.key), out, article, hosts)
            if edge:
                blocks.append([])

    for kept in (COMMENT_WORDS, NONE):
        visit(root, wrapper.start(), *_outside(root, wrapper, kept))
        lines = [" ".join("".join(b).split()) for b in blocks]
        if any(lines):
            break
    return "\n".join(line for line in lines if line)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, template, pages, wrapper as JSON) from rows (host, html)."""
    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            trees = [parse(page) for page in batch["html"]]
            yield batch[["host"]].assign(template=[template(t) for t in trees], wrapper=[to_text(_items(t)) for t in trees])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows in order of their groups; each group becomes one wrapper."""
        group, n, held, rows = None, 0, [], 0

        def out() -> pd.DataFrame:
            return pd.DataFrame([(*group[:2], n, to_text(_common(held) if rows > 1 else held))], columns=["host", "template", "pages", "wrapper"])

        for batch in batches:
            for *own, count, text in zip(*(batch[c] for c in ("host", "template", "part", "pages", "wrapper"))):
                if own != group:
                    if group:
                        yield out()
                    group, n, held, rows = own, 0, from_text(text), 1
                else:
                    held, rows = align(held, from_text(text)), rows + 1
                n += count
        if group:
            yield out()

    kind = "host string, template string, pages long, wrapper string"
    now = stored(pages.mapInPandas(single, "host string, template string, wrapper string").groupBy("host", "template", "wrapper").agg(
        F.count(F.lit(1)).alias("pages")).select("host", "template", "pages", "wrapper"), "wrappers")
    most = now.groupBy("host", "template").count().agg(F.max("count")).first()[0] or 0
    while most > 1:
        # groups by contents, so the same ones whatever the cluster is
        most = -(-most // FAN)
        keys = ["host", "template", "part"]
        grouped = now.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(most)))
        done, now = now, stored(grouped.repartition(*keys).sortWithinPartitions(*keys, "wrapper").mapInPandas(fold, kind), "wrappers")
        forget(done)
    return now


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars), one row per row of ``pages``.

    A null or empty page has an empty text.  Pages without a host (null or odd urls) count as one host.
    The only page of a template is its own wrapper.  Repeated rows are extracted each.  Headers, labels
    and buttons are left out also in an article.  Pages are read whole, however long or deep; an empty table
    gives no rows, and further columns of any name are not read.
    """
    host, _ = host_path(F.col(url_col))

    @F.pandas_udf("string")
    def templates(htmls: pd.Series) -> pd.Series:
        return pd.Series([template(parse(h)) for h in htmls], dtype=object)

    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), html.alias("html"))
    with Scratch() as scratch:
        known = scratch.keep(wrappers(rows.select("host", "html")))

    @F.pandas_udf("string")
    def texts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        held: dict[tuple[str, int], Wrapper] = {}
        for page, wrapper, n in batches:
            out = []
            for html, *own in zip(page, wrapper, n):
                own = tuple(own)
                if own not in held:
                    if len(held) > 1000:
                        held.clear()
                    held[own] = Wrapper(from_text(own[0]), own[1])
                out.append(main_text(html, held[own]))
            yield pd.Series(out, dtype=object)

    got = rows.withColumn("template", templates("html")).join(known, ["host", "template"]).select("id", "url", texts("html", "wrapper", "pages").alias("text"))
    return got.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
