"""Page jobs: items out of HTML (I1), posting records (I2), crawl audit.

Extraction rules are written the way the crawler configs write them: a
container selector and, per field, a selector plus an attribute (``text``,
``exists`` or an attribute name). One Arrow UDF lists each page's elements in
document order (tag, attributes, where the element ends, its ancestors); which of them
are containers and which is a container's first element for a field are
column expressions over that list, as is all further work (absolute links,
parsing, ids, the contract). Selector forms:
``tag``, ``*``, ``.class`` (CSS escapes allowed), ``#id``, attribute tests
``[a]``, ``[a=v]``, ``[a*=v]``, ``[a^=v]``, ``[a$=v]``, ``[a~=v]``,
``:nth-of-type(n)``, compounds of these, descendant and child steps
(``h3.title a``, ``ul > li``), adjacent siblings (``a + span``) and
comma-separated alternatives. As in CSS, a field is the container's first
inner element, in document order, that any alternative matches.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Mapping, Sequence
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions.keys import posting_id, without_id
from postlake.functions.parsing import with_experience, with_salary
from postlake.functions.urls import absolute_url, with_company
from postlake.operators.sequence import ordered_scan, splitters
from postlake.session import ensure_library, short_batches, spread, stored
from postlake.sources.contract import apply_contract

# Elements without an end tag, and those whose text is not shown.
_VOID = {"img", "input", "br", "hr", "meta", "link", "source", "area", "base", "col", "embed", "wbr"}
_HIDDEN = {"script", "style"}
# A comment, a declaration, or a tag: its slash, name, and what follows the name. The first groups are set for a script or style, whose inside up to the end tag is passed over.
_REST = r"""[^>"']*+(?:(?:"[^"]*"|'[^']*')[^>"']*+)*+"""
_INSIDE = r"[^<]*+(?:<(?!/(?i:%s)\b)[^<]*+)*+"
_MARKUP = re.compile(rf"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?:(?=[sS][cC][rR][iI][pP][tT][\s/>])()|(?=[sS][tT][yY][lL][eE][\s/>])())?+(/?)([a-zA-Z][^\s/>]*)({_REST})>"""
                     rf"""(?(1){_INSIDE % "script"})(?(2){_INSIDE % "style"})""", re.S)
# The same markup as one group, by which a page is split.
_SPLIT = re.compile(rf"""(<(?:(?:/[a-zA-Z]|[a-rt-zA-RT-Z])[^\s/>]*{_REST}>|!--.*?(?:-->|\Z)|[!?][^>]*>|[sS](?:[cC][rR][iI][pP][tT](?=[\s/>]){_REST}>{_INSIDE % "script"}"""
                    rf"""|[tT][yY][lL][eE](?=[\s/>]){_REST}>{_INSIDE % "style"}|[^\s/>]*{_REST}>)))""", re.S)
_STYLED = re.compile(r"<(?:[sS][cC][rR][iI][pP][tT]|[sS][tT][yY][lL][eE])(?!\s*>)")
_SPACE = re.compile(r"[\t\n\f\r ]")  # between the words of a class
_PAIR = re.compile(r"""([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")

#: What a page lists of its elements, in document order. ``at``: an element's place; ``css``: its class attribute; ``up``: place of the parent (-1: none);
#: ``path``: those of all ancestors; ``nth``: number among the siblings of its tag; ``left``: the sibling before it (-1: none); ``stop``: place behind
#: its last inner element; its texts are those from ``first`` up to ``last``.
_FIELDS = {"at": T.IntegerType(), "tag": T.StringType(), "css": T.StringType(), "attrs": T.MapType(T.StringType(), T.StringType(), False), "up": T.IntegerType(),
           "path": T.ArrayType(T.IntegerType(), False), **{n: T.IntegerType() for n in ("nth", "left", "stop", "first", "last")}}
#: Listed together: pages of so many characters, or one longer page. Their Python objects are gone before the next pages are listed.
SLICE_CHARS = 1 << 20
# Parsed start tags that are kept for the next of the same text, and the longest kept.
_KEPT_TAGS, _KEPT_CHARS = 4096, 256
_ALONE = 1 << 30
# Rounds in which neighbouring start and end tags are paired at once; what is left then is paired one by one.
_ROUNDS = 24


def _attributes(rest: str, names: frozenset[str] | None) -> tuple[list[str], list[str], str | None, bool]:
    """(names, values, class, whether it closes itself) of a start tag's text behind its name; only attributes in ``names`` (None: all) are listed."""
    own, closed = {}, False
    for name, double, single, bare in _PAIR.findall(rest):
        value = double or single or bare
        own[name.lower()] = unescape(value) if "&" in value else value
    if rest.rstrip()[-1:] in ("/", "="):  # behind the last pair there is nothing but white space, slashes and equals signs
        closed = "/" in rest[max((a.end() for a in _PAIR.finditer(rest)), default=0):]
    css = own.get("class")
    if names is not None:
        own = {k: v for k, v in own.items() if k in names}
    return [*own], [*own.values()], css, closed


_kept_attributes = lru_cache(_KEPT_TAGS)(_attributes)


def _hides(tag: str | None, ends: str | None, rest: str | None) -> bool:
    """Whether the text behind a tag is not shown: that of a script or style which does not close itself."""
    return bool(tag) and not ends and tag.lower() in _HIDDEN and not _attributes(rest, None)[3]


def _parts(html: str) -> tuple[list[str], list[str]]:
    """The page's texts, and the markups between them."""
    parts = _SPLIT.split(html)
    texts, markups = parts[::2], parts[1::2]
    if not _STYLED.search(html):
        return texts, markups
    starts = [m for m in map(_MARKUP.match, (x for x in markups if x[1] in "sS")) if m[4].lower() in _HIDDEN]
    if all(_hides(m[4], m[3], m[5]) == (m[1] is not None or m[2] is not None) for m in starts):
        return texts, markups
    texts, markups, at = [], [], 0  # such an element closes itself, or a quote follows its name: look behind each tag
    while m := _MARKUP.search(html, at):
        texts.append(html[at:m.start()])
        at = m.end(5) + 1 if m[4] else m.end()
        markups.append(html[m.start():at])
        if _hides(m[4], m[3], m[5]):
            end = re.compile(rf"</{m[4]}\b", re.I).search(html, at)
            at = end.start() if end else len(html)
    return [*texts, html[at:]], markups


class _Markups(dict):
    """Numbers of the different markups, each parsed once; 0 is the end of a page. ``does``: the number of the tag that it opens, less than 0 for one that
    it ends, _ALONE for an element without inside, -_ALONE for no tag. A start tag has a class and attributes, those in ``names`` (None: all), and
    stands under those of ``keys`` (tags, and classes behind a point) that are its own."""

    def __init__(self, names: frozenset[str] | None, keys: Sequence[str]):
        self.names, self.keys, self.tags = names, {k: n for n, k in enumerate(keys)}, {}
        self.does, self.kind, self.tag, self.css, self.name, self.value, self.ends = array("i", [0]), array("i", [0]), [None], [None], [], [], array("i", [0, 0])
        self.under, self.under_ends, self.classes = array("i"), array("i", [0, 0]), {None: ()}

    def __missing__(self, markup: str) -> int:
        _, _, ends, tag, rest = _MARKUP.match(markup).groups()
        css, kind, does = None, 0, -_ALONE
        if tag:
            tag = tag.lower()
            kind = self.tags.setdefault(tag, len(self.tags) + 1)
            if ends:
                does = -kind
            else:
                own, values, css, closed = (_kept_attributes if len(rest) <= _KEPT_CHARS else _attributes)(rest, self.names)
                self.name += own
                self.value += values
                does = _ALONE if closed or tag in _VOID else kind
                if tag in self.keys:
                    self.under.append(self.keys[tag])
                if css not in self.classes:
                    self.classes[css] = [self.keys[w] for w in {f".{w}" for w in _SPACE.split(css)} if w in self.keys]
                self.under.extend(self.classes[css])
        self[markup] = number = len(self.tag)
        self.does.append(does)
        self.kind.append(kind)
        self.tag.append(tag)
        self.css.append(css)
        self.ends.append(len(self.name))
        self.under_ends.append(len(self.under))
        return number


class _Listing:
    """The elements of some pages, column by column: the ``fields`` (default: all) and attributes (None: all) asked for, and the places of those of each tag or class in ``keys``."""

    def __init__(self, fields: Sequence[str] = tuple(_FIELDS), names: frozenset[str] | None = None, keys: Sequence[str] = ()):
        self.fields, self.markups = [f for f in _FIELDS if f in fields], _Markups(names, keys)
        # the markups of all pages, each page's followed by its end; whether a text that is not empty comes before them, and those texts
        self.numbers, self.shown, self.texts, self.ends = array("i"), bytearray(), [], array("i")

    def add(self, html: str) -> None:
        """List one page. Character references are decoded, in texts and attributes."""
        texts, markups = _parts(html)
        texts = [(unescape(t) if "&" in t else t).strip() if t else t for t in texts]
        self.numbers.extend(map(self.markups.__getitem__, markups))
        self.numbers.append(0)
        self.shown += bytes(map(bool, texts))
        self.texts += filter(None, texts)
        self.ends.append(len(self.numbers))

    def _nested(self, does: np.ndarray) -> np.ndarray:
        """The markup by which each markup's element ends (itself: no inside). An end tag closes the elements opened since its start tag and is
        ignored without one; elements left open end with the page."""
        ended, left = np.arange(len(does)), np.flatnonzero(np.abs(does) < _ALONE)
        for _ in range(_ROUNDS):  # a start tag, and its end tag with nothing left between: they change nothing for the others
            tags = does[left]
            pairs = np.flatnonzero((tags[:-1] > 0) & (tags[:-1] == -tags[1:]))
            ended[left[pairs]] = left[pairs + 1]
            keep = np.ones(len(left), bool)
            keep[pairs] = keep[pairs + 1] = False
            left = left[keep]
            if not len(pairs):
                break
        opened, tags = [], [0]
        for at, tag in zip(left.tolist(), does[left].tolist()):
            if tag > 0:
                opened.append(at)
                tags.append(tag)
            elif not tag:
                ended[opened] = at
                opened, tags = [], [0]
            elif -tag in tags:
                last = 0
                while last != -tag:
                    last = tags.pop()
                    ended[opened.pop()] = at
        return ended

    def column(self) -> pa.StructArray:
        ints = lambda x: pa.array(np.asarray(x, np.int32))
        filled = lambda ends, values: pa.ListArray.from_arrays(ints(ends), values, type=pa.list_(pa.field("element", values.type, False)))
        struct = lambda columns: pa.StructArray.from_arrays([*columns.values()], fields=[pa.field(n, c.type, n == "css") for n, c in columns.items()])
        strings = lambda x: pa.array(x, pa.string())
        numbers, own = np.array(self.numbers), self.markups
        does = np.array(own.does)[numbers]
        # counted up to each markup: elements and texts, from which those of the pages before are taken off
        elements, texts = np.cumsum(does > 0), np.cumsum(np.frombuffer(bytes(self.shown), np.uint8), dtype=np.int64)
        page_ends, text_ends = (np.append(0, x[np.array(self.ends, np.int64) - 1]) for x in (elements, texts))
        page = np.repeat(np.arange(len(page_ends) - 1), np.diff(page_ends))
        before, said = page_ends[page], text_ends[page]
        starts = np.flatnonzero(does > 0)
        numbers, at, ended = numbers[starts], np.arange(len(starts)), self._nested(does)[starts]
        # an element has as many ancestors as begin before it and do not end before it; the last before it that has one less is its parent
        depth = at - np.cumsum(np.bincount(elements[ended], minlength=len(at) + 1))[:len(at)]
        levels = np.split(np.argsort(depth.astype(np.min_scalar_type(depth.max(initial=0))), kind="stable"), np.cumsum(np.bincount(depth))[:-1])
        parent = np.full(len(at), -1)
        for above, level in zip(levels, levels[1:]):
            parent[level] = above[np.searchsorted(above, level) - 1]
        family = np.where(parent < 0, len(at) + page, parent)

        def alike(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Elements by key, in document order, and which of them begin a key."""
            order = np.argsort(key, kind="stable")
            return order, np.diff(key[order], prepend=-1) != 0

        def paths() -> pa.ListArray:
            """The ancestors of each element, filled in from the nearest on."""
            ends = np.cumsum(depth)
            out, place, up, off = np.empty(depth.sum(), np.int32), ends - 1, parent, before
            while len(up):
                have = up >= 0
                place, up, off = place[have], up[have], off[have]
                out[place] = up - off
                place, up = place - 1, parent[up]
            return filled(np.append(0, ends), pa.array(out))

        attributes = pa.map_(pa.string(), pa.field("value", pa.string(), False))

        def field(name: str) -> pa.Array:
            if name == "at":
                return ints(at - before)
            if name == "tag":
                return strings(own.tag).take(pa.array(numbers))
            if name == "css":
                return strings(own.css).take(pa.array(numbers))
            if name == "attrs":
                return pa.MapArray.from_arrays(ints(own.ends), strings(own.name), strings(own.value), type=attributes).take(pa.array(numbers))
            if name == "path":
                return paths()
            if name == "up":
                return ints(np.where(parent < 0, -1, parent - before))
            if name == "nth":
                order, begins = alike(family * (len(own.tags) + 1) + np.array(own.kind)[numbers])
                nth = np.empty_like(at)
                nth[order] = 1 + at - np.maximum.accumulate(np.where(begins, at, 0))
                return ints(nth)
            if name == "left":
                order, begins = alike(family)
                left = np.empty_like(at)
                left[order] = np.where(begins, -1, np.roll((at - before)[order], 1))
                return ints(left)
            if name == "stop":
                return ints(elements[ended] - before)
            return ints(texts[starts if name == "first" else ended] - said)

        out = {"elements": filled(page_ends, struct({n: field(n) for n in self.fields})), "texts": filled(text_ends, strings(self.texts))}
        if own.keys:
            ends, wide = np.array(own.under_ends, np.int64), len(own.keys)
            counts = np.diff(ends)[numbers]
            which = np.repeat(at, counts)
            under = np.array(own.under, np.int64)[np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts - ends[numbers], counts)]
            key = page[which] * wide + under
            sizes = np.bincount(key, minlength=wide * (len(page_ends) - 1))
            out["places"] = filled(wide * np.arange(len(page_ends)), filled(np.append(0, np.cumsum(sizes)), ints((at - before)[which[alike(key)[0]]])))
        return struct(out)


def _page_type(fields: Sequence[str], keys: Sequence[str]) -> T.StructType:
    """A page's type. Only a class can be null; of what cannot, Spark does not ask it."""
    element = T.StructType([T.StructField(f, _FIELDS[f], f == "css") for f in fields])
    page = T.StructType([T.StructField("elements", T.ArrayType(element, False), False), T.StructField("texts", T.ArrayType(T.StringType(), False), False)])
    return page.add("places", T.ArrayType(T.ArrayType(T.IntegerType(), False), False), False) if keys else page


def list_elements(html: Column, fields: Sequence[str] = tuple(_FIELDS), names: Sequence[str] | None = None, keys: Sequence[str] = ()) -> Column:
    """The elements, with ``fields`` and the attributes in ``names`` (None: all), and the texts of a page (null: none); with ``keys``, tags or classes
    behind a point, also ``places``: those of each key's elements, in the order of the keys."""
    fields, names = [f for f in _FIELDS if f in fields], None if names is None else frozenset(names)
    @F.arrow_udf(_page_type(fields, keys))
    def listed(html: pa.Array) -> pa.Array:
        parts, out, chars = [], _Listing(fields, names, keys), 0
        for text in html.to_pylist():
            text = text or ""
            if chars and chars + len(text) > SLICE_CHARS:
                parts.append(out.column())
                out, chars = _Listing(fields, names, keys), 0
            out.add(text)
            chars += len(text)
        parts.append(out.column())
        return pa.concat_arrays(parts)

    return listed(html)


_QUALIFIER = r"\.(?:\\.|[\w-])+|\#(?:\\.|[\w-])+|\[[^\]]*\]"
_COMPOUND = re.compile(rf"(?P<tag>[a-zA-Z][a-zA-Z0-9]*|\*)?(?P<quals>(?:{_QUALIFIER})*)(?::nth-of-type\((?P<nth>\d+)\))?")
_ATTRIBUTE = re.compile(r"""\[\s*([A-Za-z_:][-\w:.]*)\s*(?:([*^$~]?=)\s*(['"]?)(.*?)\3)?\s*\]""")
_TESTS: dict[str, Callable[[Column, str], Column]] = {
    "=": lambda have, want: have == want, "*=": lambda have, want: F.contains(have, F.lit(want)) if want else F.lit(False),
    "^=": lambda have, want: F.startswith(have, F.lit(want)) if want else F.lit(False),
    "$=": lambda have, want: F.endswith(have, F.lit(want)) if want else F.lit(False),
    "~=": lambda have, want: F.contains(have, F.lit(want)) & _has_word(have, want)}


def _has_word(have: Column, want: str) -> Column:
    """Whether ``want`` is one of the words of a text, between white space."""
    space = _SPACE.pattern
    if not want or _SPACE.search(want) or r"\E" in want:
        return F.array_contains(F.split(have, space + "+"), want)
    return have.rlike(rf"(?:^|{space})\Q{want}\E(?:{space}|\z)")  # a pattern that is compiled once, which a split's is not


def _split_top(text: str, sep: str) -> list[str]:
    """Split on ``sep`` outside brackets, parentheses and quotes."""
    out, cur, depth, quote = [], "", 0, None
    for ch in text:
        if quote:
            quote = None if ch == quote else quote
        elif ch in "'\"":
            quote = ch
        elif ch in "[(":
            depth += 1
        elif ch in "])":
            depth -= 1
        elif ch == sep and depth == 0:
            out.append(cur)
            cur = ""
            continue
        cur += ch
    out.append(cur)
    return [x.strip() for x in out if x.strip()]


def _compound(text: str) -> tuple[Callable[[Column], Column], set[str], set[str], str]:
    """Test of one compound selector on an element's columns, the fields and attributes that it reads, and the class or tag that its elements stand under (``*``: all)."""
    m = _COMPOUND.fullmatch(text)
    if not m or not text:
        raise ValueError(f"unsupported selector {text!r}")
    tag, nth, tests = (m["tag"] or "*").lower(), int(m["nth"] or 0), []
    for q in re.findall(_QUALIFIER, m["quals"]):
        name = re.sub(r"\\(.)", r"\1", q[1:])
        if q[0] == ".":
            tests.append(("class", "~=", name))
        elif q[0] == "#":
            tests.append(("id", "=", name))
        else:
            a = _ATTRIBUTE.fullmatch(q)
            if not a:
                raise ValueError(f"unsupported attribute selector {q!r}")
            tests.append((a[1].lower(), a[2], a[4]))

    def holds(e: Column) -> Column:
        out = F.lit(True) if tag == "*" else e["tag"] == tag
        if nth:
            out = out & (e["nth"] == nth)
        for name, test, want in tests:
            have = e["css"] if name == "class" else F.try_element_at(e["attrs"], F.lit(name))
            out = out & (have.isNotNull() if test is None else F.coalesce(_TESTS[test](have, want), F.lit(False)))
        return out

    names = {name for name, _, _ in tests} - {"class"}
    fields = {f for f, used in (("tag", tag != "*"), ("nth", nth), ("css", any(name == "class" for name, _, _ in tests)), ("attrs", names)) if used}
    return holds, fields, names, next((f".{want}" for name, test, want in tests if name == "class" and test == "~=" and want and not _SPACE.search(want)), tag)


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _chain(steps: list[tuple[str, Callable]], e: Column, elements: Column) -> Column:
    """Whether a chain of steps ends at the element: its last test, then the earlier steps at its ancestors or the sibling before it."""
    (relation, test), before = steps[-1], steps[:-1]
    if not before:
        return test(e)
    at = lambda place: _chain(before, F.get(elements, place), elements)
    if relation == " ":
        return test(e) & F.exists(e["path"], at)
    place = e["up"] if relation == ">" else e["left"]
    return test(e) & (place >= 0) & F.coalesce(at(place), F.lit(False))


_READ_BY = {" ": "path", ">": "up", "+": "left"}  # the field by which a step finds the elements of the step before


def _chains(selector: str) -> tuple[list[list[tuple[str, Callable]]], set[str], set[str], set[str]]:
    """A selector's alternatives as chains of steps, the fields and attributes that they read, and what their last elements stand under."""
    chains, fields, names, keys = [], set(), set(), set()
    for alternative in _split_top(selector, ","):
        steps, relation = [], " "
        for part in _split_top(re.sub(r"\s*([>+])\s*(?![^\[]*\])", r" \1 ", alternative), " "):
            if part in (">", "+"):
                relation = part
            else:
                test, own_fields, own_names, key = _compound(part)
                fields |= own_fields | ({_READ_BY[relation]} if steps else set())
                names |= own_names
                steps.append((relation, test))
                relation = " "
        chains.append(steps)
        keys.add(key)
    return chains, fields, names, keys


def _matches(selector: str, page: Mapping[str, Column], listed: Sequence[str]) -> Column:
    """The elements that any of the selector's alternatives matches, in document order; the page has the places of the keys ``listed``."""
    chains, _, _, keys = _chains(selector)
    elements = page["elements"]

    def holds(e: Column) -> Column:
        out = _chain(chains[0], e, elements)
        for steps in chains[1:]:
            out = out | _chain(steps, e, elements)
        return out

    if not keys <= set(listed):
        return F.filter(elements, holds)
    places = [F.get(page["places"], F.lit(listed.index(k))) for k in sorted(keys)]
    places = places[0] if len(places) == 1 else F.array_sort(F.array_distinct(F.concat(*places)))
    return F.filter(F.transform(places, lambda at: F.get(elements, at)), holds)


def _rules(fields: Mapping[str, Mapping]) -> list[tuple[str | None, str]]:
    return [(r.get("selector") or None, r.get("attribute", "text").lower()) for r in fields.values()]


def _keys(container: str, fields: Mapping[str, Mapping]) -> list[str]:
    """Tags and classes that the last elements of the rules' selectors stand under."""
    return sorted(set().union(*(_chains(s)[3] for s in {container, *(s for s, _ in _rules(fields) if s)})) - {"*"})


def _reads(container: str, fields: Mapping[str, Mapping]) -> tuple[set[str], set[str]]:
    """Fields and attributes of a page's elements that the rules read."""
    rules, read, names = _rules(fields), {"at", "stop", "first", "last"}, set()
    for selector in dict.fromkeys([container, *(s for s, _ in rules if s)]):
        _, own_fields, own_names, _ = _chains(selector)
        read, names = read | own_fields, names | own_names
    names |= {a for _, a in rules if a not in ("text", "exists")}
    return read | ({"attrs"} if names else set()), names


def _items(page: Mapping[str, Column], container: str, fields: Mapping[str, Mapping]) -> Column:
    """For each container of a page, an array of its fields' values as text (null: absent)."""
    rules = _rules(fields)
    inner = {s: f"s{n}" for n, s in enumerate(dict.fromkeys(s for s, _ in rules if s))}
    keys = _keys(container, fields)
    matches = F.struct(_matches(container, page, keys).alias("own"), *[_matches(s, page, keys).alias(n) for s, n in inner.items()])

    def value(found: Column, attribute: str) -> Column:
        if attribute == "exists":
            return F.when(found.isNotNull(), F.lit("true"))
        if attribute == "text":
            return F.when(found["last"] > found["first"], F.array_join(F.slice(page["texts"], found["first"] + 1, found["last"] - found["first"]), ""))
        return F.try_element_at(found["attrs"], F.lit(attribute))

    def first(own: Column, of: Column) -> Column:
        return F.get(F.filter(of, lambda e: (e["at"] > own["at"]) & (e["at"] < own["stop"])), F.lit(0))

    def item(own: Column, all_: Column) -> Column:
        values = lambda found: F.array(*[value(own if s is None else found[inner[s]], a) for s, a in rules] or [F.lit(None).cast("string")])
        return _bind(F.struct(*[first(own, all_[n]).alias(n) for n in inner.values()]), values) if inner else values(own)

    return _bind(matches, lambda all_: F.transform(all_["own"], lambda own: item(own, all_)))


def load_crawler_config(path: str) -> dict:
    """Read a crawler YAML config: ``name``, ``base_url``, ``container_selector`` and ``fields``."""
    import yaml

    with open(path, encoding="utf-8") as fh:
        cfg = yaml.safe_load(fh)
    missing = {"container_selector", "fields"} - set(cfg)
    if missing:
        raise ValueError(f"crawler config lacks {sorted(missing)}")
    return cfg


def extract_with_config(pages: DataFrame, cfg: dict, html_col: str = "html",
                        keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """I1 with a crawler config: items and fields by its rules, links made absolute."""
    return extract_items(pages, cfg["container_selector"], cfg["fields"], html_col=html_col,
                         keep=keep, base_url=cfg.get("base_url"))


def extract_items(pages: DataFrame, container: str, fields: Mapping[str, Mapping],
                  html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"),
                  base_url: str | Column | None = None) -> DataFrame:
    """One row per container element with one column per field rule.

    ``fields`` maps a name to ``{"selector": ..., "attribute": ...}``; a null
    selector means the container itself. ``text`` gives stripped text (empty →
    null), ``exists`` gives true/false, any other attribute gives its value,
    and a root-relative ``href`` is made absolute with ``base_url``. A field
    whose element is absent is null (``exists``: false). ``item_pos`` is the
    item's position on its page; containers inside containers are items too.
    """
    ensure_library(pages.sparkSession)
    clash = set(keep) & set(fields)
    if clash:
        raise ValueError(f"field names collide with kept page columns: {sorted(clash)}")
    parts = ("elements", "texts", *(["places"] if _keys(container, fields) else []))
    rules = _items({p: F.col(f"_{p}") for p in parts}, container, fields)
    short_batches(pages.sparkSession)
    listed = spread(pages.select(*[F.col(k) for k in keep], F.col(html_col).alias("_html")), "_html")
    listed = listed.select(*[F.col(k) for k in keep], list_elements(F.col("_html"), *_reads(container, fields), _keys(container, fields)).alias("_page"))
    listed = listed.select(*[F.col(k) for k in keep], *[F.col("_page")[p].alias(f"_{p}") for p in parts])
    exploded = listed.select(*[F.col(k) for k in keep], F.posexplode(rules).alias("item_pos", "_item"))
    cols = []
    for n, (name, rule) in enumerate(fields.items()):
        c = F.col("_item")[n]
        attr = rule.get("attribute", "text").lower()
        if attr == "exists":
            c = c.isNotNull()
        elif attr == "href" and base_url is not None:
            c = absolute_url(c, base_url)
        cols.append(c.alias(name))
    return exploded.select(*[F.col(k) for k in keep], "item_pos", *cols)


def content_key(df: DataFrame) -> Column:
    """sha256 of all columns of ``df`` in name order, each value as its length and text (``-`` for null)."""
    values = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        c = F.col(f"`{f.name}`")
        values.append(c.cast("string") if f.dataType.typeName() not in ("array", "struct", "map") else F.to_json(c))
    # one expression for all columns: spelled out for each, the generated method is too long to be compiled to machine code
    parts = F.transform(F.array(*values), lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")))
    return F.sha2(F.array_join(parts, ""), 256)


def build_postings(items: DataFrame, source, crawled_at, usd_rate: float = 25000.0,
                   fallback_id: Column | None = None) -> DataFrame:
    """Assemble contract records from extracted fields.

    Order of the steps: company from the URL slug when empty → stable id
    (sha256 of the cleaned URL, else the cleaned id or its numeric tail, else
    ``fallback_id``, by default a hash of the whole item with its source, crawl
    time, page and position, so that different items keep different ids) → salary and experience parsing → projection onto the
    contract (defaults filled, required strings non-null). ``source`` and
    ``crawled_at`` are literals or columns.
    """
    src = source if isinstance(source, Column) else F.lit(source)
    ts = crawled_at if isinstance(crawled_at, Column) else F.lit(crawled_at)
    base = items.withColumn("source", src).withColumn("crawled_at", ts.cast("bigint"))
    for c in ("job_id", "company", "url", "salary", "experience"):
        if c not in base.columns:
            base = base.withColumn(c, F.lit(None).cast("string"))
    fb = fallback_id if fallback_id is not None else content_key(base)
    base = base.withColumn("job_id", F.col("job_id").cast("string"))
    base = base.withColumn("_fallback", F.when(without_id("job_id", "url"), fb))
    base = with_company(base, "company", "url")
    base = base.withColumn("job_id", posting_id("job_id", "url", F.col("_fallback")))
    base = with_experience(with_salary(base, "salary", usd_rate), "experience")
    return apply_contract(base)


# Stop rules of the crawl loop.
REDUNDANCY_LIMIT = 0.5
SMALL_PAGE_BASELINE = 15
SMALL_PAGE_SHARE = 0.6
SMALL_PAGE_RUN = 2
IDENTICAL_PAGE_RUN = 2


def crawl_audit(items: DataFrame, source_col: str, page_col: str, id_col: str,
                pages: DataFrame | None = None) -> DataFrame:
    """Per source and page: the crawl loop's counters and the stop reason of that page.

    ``n_items`` counts items (repeats included); ``new_ids`` counts distinct
    ids first seen, in page order, on this page; ``redundancy = 1 - new/n``;
    ``max_items`` is the running maximum of ``n_items``; a page is small when
    ``max_items >= 15`` and ``n_items <= 0.6 * max_items``; ``small_run`` and
    ``identical_run`` count consecutive small pages and pages whose id
    multiset equals the previous page's. ``stop_reason`` is the first rule
    that fires (empty, redundant, small_pages, no_new, identical_pages), else
    null, and ``first_stop`` marks the first page of the source where one
    fires. An empty page has no item rows, so it appears only when ``pages``
    (every crawled ``source_col``/``page_col`` pair) is given; its redundancy
    is 1.

    Page identity: every page has sums of its ids' hashes (128 bits in four parts), made in the aggregate that counts its
    items; a page whose count and sums equal those of the page before is compared with it id by id, which is exact
    and reads only such pages' items. Running values come from the range-partitioned
    ordered scan, so a source with most of the pages is still split.
    """
    src = items.select(F.col(source_col).alias("source"), F.col(page_col).alias("page"),
                       F.col(id_col).cast("string").alias("item_id"))
    hashes = [F.xxhash64(F.lit(seed), "item_id") for seed in (1, 2)]
    halves = [half for h in hashes for half in (h.bitwiseAND(F.lit(2 ** 32 - 1)), F.shiftrightunsigned(h, 32))]
    per_page = src.groupBy("source", "page").agg(F.count(F.lit(1)).alias("n_items"), F.struct(*[F.sum(h).alias(f"h{i}") for i, h in enumerate(halves)]).alias("_ids"))
    first_seen = (src.groupBy("source", "item_id").agg(F.min("page").alias("page"))
                     .groupBy("source", "page").agg(F.count(F.lit(1)).alias("new_ids")))
    if pages is not None:
        crawled = pages.select(F.col(source_col).alias("source"), F.col(page_col).alias("page")).distinct()
        per_page = crawled.join(per_page, ["source", "page"], "full_outer").fillna(0, ["n_items"])
    pages = stored(per_page.join(first_seen, ["source", "page"], "left").fillna(0, ["new_ids"]), "audit-counts")
    cuts = splitters(pages, ["source"], ["page"])
    s1 = ordered_scan(pages, ["source"], ["page"], prev=["page", "n_items", "_ids"], running_max=["n_items"], cuts=cuts)
    s1 = stored(s1.withColumn("_alike", (F.col("n_items") > 0) & (F.col("prev_n_items") == F.col("n_items")) & (F.col("prev__ids") == F.col("_ids"))), "audit-pages")
    alike = s1.where("_alike").select("source", "page", "prev_page")
    own = src.join(alike, ["source", "page"]).select("source", "page", "item_id", F.lit(1).alias("_side"))
    other = src.join(alike.select("source", F.col("prev_page").alias("page"), F.col("page").alias("_of")), ["source", "page"]) \
        .select("source", F.col("_of").alias("page"), "item_id", F.lit(-1).alias("_side"))
    differ = own.union(other).groupBy("source", "page", "item_id").agg(F.sum("_side").alias("_n")).where("_n <> 0") \
        .select("source", "page", F.lit(True).alias("_differ")).distinct()
    flagged = s1.join(differ, ["source", "page"], "left").select(
        "source", "page", "n_items", "new_ids",
        F.when(F.col("n_items") > 0, 1.0 - F.col("new_ids") / F.col("n_items"))
         .otherwise(F.lit(1.0)).alias("redundancy"),
        F.col("max_n_items").cast("long").alias("max_items"),
        ((F.col("max_n_items") >= SMALL_PAGE_BASELINE)
         & (F.col("n_items") <= F.col("max_n_items") * SMALL_PAGE_SHARE)).alias("small"),
        F.coalesce(F.col("_alike") & F.col("_differ").isNull(), F.lit(False)).alias("identical"))
    s2 = ordered_scan(stored(flagged, "audit-flags"), ["source"], ["page"], runs=["small", "identical"], cuts=cuts)
    reason = (F.when(F.col("n_items") == 0, F.lit("empty"))
               .when(F.col("redundancy") > REDUNDANCY_LIMIT, F.lit("redundant"))
               .when(F.col("run_small") >= SMALL_PAGE_RUN, F.lit("small_pages"))
               .when(F.col("new_ids") == 0, F.lit("no_new"))
               .when(F.col("run_identical") >= IDENTICAL_PAGE_RUN, F.lit("identical_pages")))
    audited = s2.select("source", "page", "n_items", "new_ids", "redundancy", "max_items",
                        F.col("run_small").alias("small_run"),
                        F.col("run_identical").alias("identical_run"),
                        reason.alias("stop_reason"))
    stops = (audited.where(F.col("stop_reason").isNotNull())
                    .groupBy("source").agg(F.min("page").alias("_stop_page")))
    return (audited.join(stops, "source", "left")
                   .withColumn("first_stop", F.coalesce(F.col("page") == F.col("_stop_page"), F.lit(False)))
                   .drop("_stop_page"))
