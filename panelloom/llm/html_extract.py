"""Operator 12: main text of web pages through wrappers, union-free regular expressions inferred per host."""

from __future__ import annotations

import html as entities
import json
import re
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelloom.llm.common import keep_table, table

# HTML elements by what they mean for text.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var".split())
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript noembed noframes template xmp svg math".split())
DROPPED = frozenset("nav aside footer form button select dialog menu head fieldset".split())
CELLS = frozenset("td th caption".split())
# What ends an open element of the kind, and where the search for one stops.
IMPLIED_END = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
               "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"})}
# Words of class, id and role that name what is not the article.
BOILERPLATE = frozenset("""ad ads adv advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion cookie cookies
consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended
recommendations trending popular sidebar widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs toolbar masthead topbar header
footer comment comments commentlist reply replies respond disqus discussion form search pagination pager complementary contentinfo""".split())
CONTENT = frozenset("article articlebody content entry main post story".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORDS_OF_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
DIGITS = re.compile(r"[0-9]+")
# A text that so many pages of a host show alike, and no paragraph or heading, belongs to the wrapper.
FIXED_PAGES = 4
# The part of the words a container must hold to be gone into.
MAIN_SHARE = 0.6
FAN_IN = 64
PENDING = 2000
TEXT = "#"
ROOT = 0
MERGE = "host string, shape string, numbers array<long>"
DECISION = "host string, pages long, wrapper string, main long, fixed array<long>"


class Item:
    """A place in a wrapper: an element by its key, or a text.  ``linked`` joins it with the next one in a repeated group."""

    __slots__ = ("key", "body", "optional", "repeated", "linked", "pages", "words", "digest")

    def __init__(self, key: str):
        self.key, self.body = key, []
        self.optional = self.repeated = self.linked = False
        self.pages, self.words, self.digest = 1, 0, 0


def _joined(a: Item, b: Item, within_page: bool) -> Item:
    """One item for two that match; texts that differ become a slot (digest 0)."""
    out = Item(a.key)
    out.optional, out.repeated = a.optional or b.optional, a.repeated or b.repeated
    out.pages = max(a.pages, b.pages) if within_page else a.pages + b.pages
    out.words = a.words + b.words
    out.digest = a.digest if a.digest == b.digest else 0
    out.body = aligned(a.body, b.body, within_page)
    return out


def _link(items: Sequence[Item], first: int, last: int) -> None:
    for item in items[first:last]:
        item.linked = True


def folded(items: Sequence[Item], within_page: bool = True) -> list[Item]:
    """The items with every key once: a key that comes again closes a repetition from its first place on.

    Beside each other that is one repeated item, else a repeated group of optional ones.
    """
    out: list[Item] = []
    places: dict[str, int] = {}
    for item in items:
        if item.key not in places:
            places[item.key] = len(out)
            out.append(item)
            continue
        at = places[item.key]
        # A link of the item that goes leads to what follows it.
        linked, last = item.linked, len(out) - 1
        kept = _joined(out[at], item, within_page)
        kept.linked = out[at].linked
        out[at] = kept
        if at == last:
            # At the end of a group the group repeats it.
            kept.repeated = kept.repeated or not (at and out[at - 1].linked)
            kept.linked = linked
        else:
            _link(out, at, last)
            out[last].linked = linked
    if out:
        out[-1].linked = False
    for i, item in enumerate(out):
        if item.linked or i and out[i - 1].linked:
            item.optional = True
    return out


def aligned(a: Sequence[Item], b: Sequence[Item], within_page: bool = False) -> list[Item]:
    """The longest common sequence of keys stays; what only one side has becomes optional."""
    if not a and not b:
        return []
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in reversed(range(n)):
        for j in reversed(range(m)):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i].key == b[j].key else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    spans: list[list[int | None]] = [[None] * n, [None] * m]
    while i < n or j < m:
        if i < n and j < m and a[i].key == b[j].key:
            spans[0][i] = spans[1][j] = len(out)
            out.append(_joined(a[i], b[j], within_page))
            i, j = i + 1, j + 1
            continue
        side, at = (0, i) if j == m or i < n and best[i + 1][j] >= best[i][j + 1] else (1, j)
        single = (a, b)[side][at]
        single.optional = True
        spans[side][at] = len(out)
        out.append(single)
        i, j = (i + 1, j) if side == 0 else (i, j + 1)
    links = [(spans[side][k], spans[side][k + 1]) for side, items in enumerate((a, b)) for k in range(len(items) - 1) if items[k].linked]
    for item in out:
        item.linked = False
    for first, last in links:
        _link(out, first, last)
    return folded(out, within_page)


def flat(items: Sequence[Item]) -> tuple[str, list[int]]:
    """The expression as JSON, in order of opening, and its numbers of pages and words and its digests beside it."""
    shape, numbers, stack = [], [], [(iter(items), 0)]
    while stack:
        item = next(stack[-1][0], None)
        if item is None:
            stack.pop()
            continue
        shape.append([len(stack), item.key, item.optional | item.repeated << 1 | item.linked << 2])
        numbers += [item.pages, item.words, item.digest]
        stack.append((iter(item.body), 0))
    return json.dumps(shape, separators=(",", ":"), ensure_ascii=False), numbers


def nested(shape: str, numbers: Sequence[int]) -> list[Item]:
    top: list[Item] = []
    bodies = [top]
    for at, (level, key, flags) in enumerate(json.loads(shape)):
        item = Item(key)
        item.optional, item.repeated, item.linked = bool(flags & 1), bool(flags & 2), bool(flags & 4)
        item.pages, item.words, item.digest = numbers[3 * at:3 * at + 3]
        del bodies[level:]
        bodies[-1].append(item)
        bodies.append(item.body)
    return top


def written(items: Sequence[Item]) -> str:
    """The expression for people: `?` optional, `+` repeated, `#` a text slot, `"` a fixed text."""
    out, group = "", False
    for item in items:
        if item.linked and not group:
            out, group = out + "( ", True
        mark = ("*" if item.optional else "+") if item.repeated else "?" if item.optional else ""
        inner = f" {{ {written(item.body)}}}" if item.body else ""
        out += ('"' if item.digest else TEXT) + mark + " " if item.key == TEXT else f"{item.key}{inner}{mark} "
        if group and not item.linked:
            out, group = out + ")+ ", False
    return out


class Page:
    """A page's text blocks in order, each with the element it stands in, and the page as a wrapper of itself."""

    def __init__(self, source: str):
        self.blocks: list[tuple[int, str]] = []
        # Elements that may hold text, parents first: parent, path, name, key, in the page's main element.
        self.parent, self.path, self.names, self.items = [ROOT], [ROOT], [""], [Item("")]
        self._read(source)
        for item in reversed(self.items):
            item.words = sum(x.words for x in item.body)
            item.body = folded(item.body)

    def _read(self, source: str) -> None:
        # Open elements: name, number of the element, why its text is dropped ("" if it is not), inside an article.
        stack: list[tuple[str, int, str, bool]] = [("", ROOT, "", False)]
        text: list[str] = []
        at = 0
        while at < len(source):
            found = TOKEN.search(source, at)
            stop = found.start() if found else len(source)
            if stop > at and not stack[-1][2]:
                text.append(entities.unescape(source[at:stop]))
            if found is None:
                break
            at = found.end()
            closes, name = found.group(1), found.group(2)
            if name is None:
                continue
            name = name.lower()
            if closes:
                if any(entry[0] == name for entry in stack):
                    if name not in INLINE:
                        self._flush(stack, text)
                    while stack[-1][0] != name:
                        stack.pop()
                    stack.pop()
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(source, at)
                if not found.group(0).endswith("/>") or name not in ("svg", "math"):
                    close = source.find(">", end.start()) if end else -1
                    at = close + 1 if close >= 0 else len(source)
                continue
            if name in VOID:
                if not stack[-1][2]:
                    if name == "hr":
                        self._flush(stack, text)
                    text.append(" " if name == "br" else "")
                continue
            self._open(name, found.group(3), stack, text)
        self._flush(stack, text)

    def _open(self, name: str, attributes: str, stack: list[tuple[str, int, str, bool]], text: list[str]) -> None:
        told = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
        inside = stack[-1][3]
        why = stack[-1][2] or _reason(name, told, inside)
        if name in INLINE:
            if why and not stack[-1][2]:
                stack.append((name, stack[-1][1], why, inside))
            return
        self._flush(stack, text)
        ends, until = IMPLIED_END.get(name, ((), ()))
        if any(entry[0] == "p" for entry in stack):
            while stack[-1][0] != "p":
                stack.pop()
            stack.pop()
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in until:
                break
            if stack[depth][0] in ends:
                del stack[depth:]
                break
        inside, why = stack[-1][3], stack[-1][2] or _reason(name, told, stack[-1][3])
        if name in ("article", "main") and why in ("form", "class") and not inside and not _reason(name, told, inside):
            # A container around the article is no advert, whatever it is called.
            stack[:] = [(n, e, "" if w == why else w, i) for n, e, w, i in stack]
            why = stack[-1][2]
        element = stack[-1][1]
        if not why:
            key = _key(name, told)
            item = Item(key)
            self.items[element].body.append(item)
            self.parent.append(element)
            self.path.append(step(self.path[element], key))
            self.names.append(name)
            self.items.append(item)
            element = len(self.items) - 1
        stack.append((name, element, why, inside or name in ("article", "main")))

    def _flush(self, stack: list[tuple[str, int, str, bool]], text: list[str]) -> None:
        plain = " ".join("".join(text).split())
        text.clear()
        if plain:
            element = stack[-1][1]
            item = Item(TEXT)
            item.digest = xxhash.xxh3_64_intdigest(plain.encode("utf-8", "replace")) >> 1 or 1
            item.words = plain.count(" ") + 1
            self.items[element].body.append(item)
            self.blocks.append((element, plain))

    def main_text(self, main: int | None, fixed: Iterable[int]) -> str:
        """The blocks below the main path, by the page's own wrapper where the page has no such path."""
        if main is None or main not in self.path:
            main, own = decide(self.items[ROOT].body, self.items[ROOT].pages)
            fixed = own
        inside, left = [path == main for path in self.path], set(fixed)
        for i, parent in enumerate(self.parent):
            inside[i] = inside[i] or inside[parent]
        return "\n".join(text for element, text in self.blocks if inside[element] and self.path[element] not in left)


def step(path: int, key: str) -> int:
    """The name of the path that goes on to a child."""
    return xxhash.xxh3_64_intdigest(b"%d/%s" % (path, key.encode("utf-8", "replace"))) >> 1 or 1


def _key(name: str, told: dict[str, str]) -> str:
    if name in ("html", "body", "article", "main"):
        return name
    if told.get("role") == "main" or told.get("itemprop") == "articleBody":
        return "main"
    classes = "".join(f".{c}" for c in sorted(told.get("class", "").split()))
    return name + DIGITS.sub("0", classes + (f"#{told['id'].strip()}" if told.get("id") else ""))


def _named_words(told: dict[str, str]) -> set[str]:
    """The words of class, id and role names, without those of names that say `has`, `with` or `no`."""
    words: set[str] = set()
    for name in " ".join(told.values()).split():
        parts = [w.lower() for w in WORDS_OF_NAME.findall(name)]
        if not {"has", "with", "no"} & set(parts):
            words.update(parts)
    return words


def _reason(name: str, told: dict[str, str], inside: bool) -> str:
    """Why an element's text is not the article's; inside an article its header belongs to it."""
    if name in DROPPED:
        return "form" if name == "form" else "element"
    if name == "header":
        return "" if inside else "element"
    if name in ("html", "body", "main") or not told:
        return ""
    named = _named_words(told) & BOILERPLATE
    if name == "article":
        named &= {"comment", "comments", "reply"}
    if inside:
        named -= {"header"}
    return "class" if named else ""


def decide(items: Sequence[Item], pages: int) -> tuple[int, list[int]]:
    """The path of the wrapper's main element and the paths of its fixed texts.

    Main is the `article` with the most words, else `main` or what is named as the content, else the
    element that one comes to by going into the child with most of the words; fixed texts have none.
    """
    places: list[tuple[int, Item, int, int]] = []
    whole = Item("")
    whole.body, whole.pages = list(items), pages
    stack = [(ROOT, whole, -1)]
    while stack:
        path, item, parent = stack.pop()
        places.append((path, item, parent, len(places)))
        stack += [(step(path, child.key), child, len(places) - 1) for child in reversed(item.body) if child.key != TEXT]
    for _, item, _, _ in reversed(places):
        item.words = sum(child.words for child in item.body if child.key != TEXT or not child.digest or child.pages < FIXED_PAGES)
    chosen = None
    for wanted in (lambda k: k == "article", lambda k: k == "main", _names_content):
        found = [p for p in places if p[1].words and wanted(p[1].key)]
        if wanted is _names_content:
            found = [p for p in found if p[1].words >= whole.words / 2]
        if found:
            chosen = max(found, key=lambda p: (p[1].words, -p[3]))
            break
    if chosen is None:
        chosen = places[0]
        while True:
            below = [p for p in places if p[2] == chosen[3] and p[1].words >= MAIN_SHARE * chosen[1].words and p[1].words]
            if not below or below[0][1].key.split(".")[0].split("#")[0] in PROSE:
                break
            chosen = below[0]
    inside = {chosen[3]}
    for place in places:
        if place[2] in inside:
            inside.add(place[3])
    texts = [(path, item.key, child) for path, item, _, number in places if number in inside for child in item.body if child.key == TEXT]
    if not any(child.digest == 0 for _, _, child in texts):
        return chosen[0], []
    return chosen[0], sorted(path for path, key, child in texts if child.digest and child.pages >= FIXED_PAGES
                             and key.split(".")[0].split("#")[0] not in PROSE)


def _names_content(key: str) -> bool:
    return bool({w.lower() for w in WORDS_OF_NAME.findall(key.partition(".")[2] or key.partition("#")[2])} & CONTENT)


def added(numbers: list[int], more: Sequence[int]) -> list[int]:
    """Numbers of two page sets of one shape: pages and words add up, a digest stays where it is the same."""
    out = [x + y for x, y in zip(numbers, more)]
    out[2::3] = [x if x == y else 0 for x, y in zip(numbers[2::3], more[2::3])]
    return out


def _rows(schema: str, rows: Sequence[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _deep(function: Callable) -> Callable:
    """Elements nest as deep as a page likes; what walks them needs as many calls."""
    def run(rows):
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 200_000))
        return function(rows)
    return run


def page_shapes(pages: DataFrame) -> DataFrame:
    """Per host the distinct shapes of its pages with their numbers, pages of equal shape added up as they are read."""

    @_deep
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], list[int]] = {}
        for batch in batches:
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shape, numbers = flat(Page(source or "").items[ROOT].body)
                if (before := known.get((host, shape))) is not None:
                    numbers = added(before, numbers)
                known[host, shape] = numbers
            if len(known) >= PENDING:
                yield _rows(MERGE, [(*name, numbers) for name, numbers in known.items()])
                known = {}
        yield _rows(MERGE, [(*name, numbers) for name, numbers in known.items()])

    return pages.mapInArrow(run, MERGE)


def same_shape(rows: pa.Table) -> pa.Table:
    part = rows.to_pydict()
    return pa.Table.from_batches([_rows(MERGE, [(part["host"][0], part["shape"][0], reduce(added, part["numbers"]))])])


@_deep
def merged(rows: pa.Table) -> pa.Table:
    """Aligns the expressions of some shapes of a host, in the order of the shapes."""
    part = rows.sort_by("shape").to_pydict()
    whole = reduce(aligned, (nested(s, n) for s, n in zip(part["shape"], part["numbers"])))
    return pa.Table.from_batches([_rows(MERGE, [(part["host"][0], *flat(whole))])])


@_deep
def decided(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            items = nested(row["shape"], row["numbers"])
            pages = max((i.pages for i in items), default=0)
            out.append((row["host"], pages, written(items).strip(), *decide(items, pages)))
        yield _rows(DECISION, out)


def wrappers(pages: DataFrame, html: str = "html") -> DataFrame:
    """host, pages, wrapper, main, fixed: the expression of each value of ``host`` and what it says of the main text.

    Pages become token streams folded into their own repetitions; those of equal shape are added up where
    they are read.  Shapes are then aligned in rounds of up to 64 per task until a host has one expression:
    equal tokens stay, unequal texts become slots, what comes again becomes a repeated group, what is
    missing somewhere an optional one.  The order of alignment follows the shapes alone.
    """
    shapes = page_shapes(pages.select("host", html))
    now = keep_table(shapes.withColumn("_s", F.xxhash64("shape")).groupBy("host", "_s", "shape")
                     .applyInArrow(same_shape, MERGE), "wrapper-shapes")
    turn = 0
    while (now.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        placed = now.withColumn("_n", F.row_number().over(Window.partitionBy("host").orderBy("shape")))
        now = keep_table(placed.withColumn("_n", F.expr(f"(_n - 1) div {FAN_IN}")).groupBy("host", "_n").applyInArrow(merged, MERGE), f"wrapper-{turn}")
        turn += 1
    return now.mapInArrow(decided, DECISION)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: key, url, text and n_chars, the main text's code points.

    The main text is what stands below the main element of the host's wrapper, or of the page's own where
    the page has no such element, without elements that are never the article (menus, headers, footers,
    sidebars, notices, adverts, forms, reader comments, scripts, styles) and without texts that the wrapper
    shows to be the same on at least four pages and that are no paragraph or heading.  Blocks are parted by
    the start and end of elements other than inline ones; `br` is white space.

    NULL or empty html gives an empty text.  NULL urls and urls without `://` share one wrapper.  Repeated
    pages give repeated rows; an empty table has none.  Other columns are not looked at, whatever their names.
    """
    address = F.coalesce(F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")), F.lit(""))
    host = F.translate(F.regexp_extract(address, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    named = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"), host.alias("host"), F.col(html).alias("_html"))
    found = keep_table(wrappers(named, "_html"), "wrapper-decisions").select("host", "main", "fixed")
    kind = pages.schema[key].dataType.simpleString()

    @_deep
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(source or "").main_text(main, fixed or ())
                     for source, main, fixed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["_key", "_url", "text", "n_chars"])

    out = named.join(found, "host", "left").select("_key", "_url", "_html", "main", "fixed").mapInArrow(run, f"_key {kind}, _url string, text string, n_chars long")
    return out.withColumnsRenamed({"_key": key, "_url": url})


def op12_html_extraction(spark, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
