"""Element tree of HTML pages in column expressions.

A page is split once into its tags and the text between them (``texts[i]``
stands before ``tags[i]``). One fold over the tags keeps the stack of open
elements and gives the span of every selected element, nested to any depth: an
end tag closes the nearest open element of its name and all that was left open
inside it; an end tag without one is ignored; void and self-closed elements
are empty; what is open at the end of the page ends there. These are the rules
of the common Python tree builder on top of ``html.parser``.

The stack holds runs of equal names, so a tag costs time in proportion to the
changes of name above it, not to its depth. Found spans are gathered in chunks.

Spans are (no, last, sel, start, stop): ``no`` numbers the selected elements in
page order, ``last`` is the number of the last one opened inside; ``start`` and
``stop`` are tag positions, so the element's text nodes are
``texts[start + 1 .. stop]``. ``sel`` has bit i set for selector i.

The extraction jobs take a page's rows from ``page_rows``, which applies the same
rules in the tasks: the fold over lambdas is interpreted and costs about 0.7 ms
for a page of ten tags, more than ten times as much.
"""

from __future__ import annotations

import html.entities
import re
from collections import defaultdict
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.columns import PY_SPACE_CHARS, strip_py_space

# A tag, comment, declaration, or a script or style with its body. Quoted
# attribute values may hold brackets. What is not closed ends with the page.
TAG = (r"""(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"""
       r"""|</?[a-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|</?[a-z][^>]*>|<[!?/][^>]*>""")
# Elements that never have content.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
CHUNK = 128

ENTITY = r"&(?:#[0-9]{1,9}|#[xX][0-9a-fA-F]{1,8}|[a-zA-Z][a-zA-Z0-9]{1,31}(?=;));?"
# The names of HTML 4, common ones first because a map literal is searched in order.
_FIRST = ["amp", "nbsp", "lt", "gt", "quot", "laquo", "raquo", "mdash", "ndash"]
_NAMES = {n: html.entities.name2codepoint[n] for n in [*_FIRST, *html.entities.name2codepoint]} | {"apos": 0x27}
# Codes 128 to 159 stand for the characters of windows-1252, as browsers read them.
_WINDOWS = {b: bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160)}


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often and however
    deep in lambdas the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def decode_entities(c: Column) -> Column:
    """Numeric and named character references as characters; unknown names
    stay as they are."""
    def one(e: Column) -> Column:
        body = F.rtrim(F.substring(e, 2, 40), F.lit(";"))
        hexadecimal = F.lower(F.substring(body, 2, 1)) == "x"
        code = F.when(hexadecimal, F.conv(F.substring(body, 3, 10), 16, 10)).otherwise(F.substring(body, 2, 10)).cast("long")
        valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
        plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        number = (F.when(code.between(128, 159), F.element_at(_literal_map(_WINDOWS), code.cast("int")))
                  .when(valid, plain).otherwise(F.lit("�")))
        named = F.coalesce(F.element_at(_literal_map({n: chr(p) for n, p in _NAMES.items()}), body), e)
        return F.when(F.substring(body, 1, 1) == "#", number).otherwise(named)

    parts, found = F.split(c, ENTITY), F.regexp_extract_all(c, F.lit(ENTITY), F.lit(0))
    joined = F.array_join(F.zip_with(parts, F.transform(found, one), lambda p, e: F.concat(p, F.coalesce(e, F.lit("")))), "")
    return F.when(F.contains(c, F.lit("&")), joined).otherwise(c)


def page_tags(html_col: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(html_col, F.lit("")), F.lit(TAG), F.lit(0))


def page_texts(html_col: Column) -> Column:
    return F.split(F.coalesce(html_col, F.lit("")), TAG)


def has_class(tag: Column, css_class: str) -> Column:
    """The tag's class attribute holds this class."""
    return F.contains(tag, F.lit(css_class)) & F.rlike(tag, F.lit(_class_pattern(css_class)))


def _class_pattern(css_class: str) -> str:
    one = rf"(?:[^QQ]*\s)?{css_class}(?:\s[^QQ]*)?"
    return (r"(?is)^<[^\s>]+(?:[^>\"']|\"[^\"]*\"|'[^']*')*?\sclass\s*=\s*(?:\"" + one.replace("QQ", '\\"') + "\"|'"
            + one.replace("QQ", "'") + rf"'|{css_class}(?=[\s/>]))")


def attribute(tag: Column, name: str) -> Column:
    """The decoded value of an attribute of a tag, '' where it is missing."""
    return let(F.concat(*[F.regexp_extract(tag, _attribute_pattern(name), i) for i in (1, 2, 3)]), decode_entities)


def _attribute_pattern(name: str) -> str:
    return rf"""(?is)^<[^\s>]+(?:[^>"']|"[^"]*"|'[^']*')*?\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def _tag_rows(tags: Column, selectors: list[tuple[str, str | None]]) -> Column:
    """Per tag: what it does (1 opens, -1 closes, 0 neither), its name and the
    selectors that it matches."""
    def row(t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, r"^</?([a-zA-Z][^\s/>]*)", 1))
        closes = F.startswith(t, F.lit("</"))
        bits = F.lit(0)
        for i, (tag, css_class) in enumerate(selectors):
            fits = name == tag
            bits = bits + F.when(fits & has_class(t, css_class) if css_class else fits, 1 << i).otherwise(0)
        inert = (name == "") | name.isin("script", "style")
        empty = F.endswith(t, F.lit("/>")) | name.isin(*VOID)
        does = F.when(inert, 0).when(closes, -1).when(empty, 2).otherwise(1)
        return F.struct(does.alias("does"), name.alias("name"), F.when(closes | inert, 0).otherwise(bits).alias("sel"))

    return F.transform(tags, row)


_RUN = "struct<name:string,n:int>"
_OPEN = "struct<no:int,sel:int,start:int,level:int>"
_SPAN = "struct<no:int,last:int,sel:int,start:int,stop:int>"


def _state(at, level, opened, runs, marks, found) -> Column:
    return F.struct(at.alias("at"), level.alias("level"), opened.alias("opened"), runs.alias("runs"), marks.alias("marks"),
                    found.alias("found"))


def _span(no, last, sel, start, stop) -> Column:
    return F.struct(no.alias("no"), last.alias("last"), sel.alias("sel"), start.alias("start"), stop.alias("stop"))


def _ended(marks: Column, opened: Column, stop: Column) -> Column:
    return F.transform(marks, lambda m: _span(m["no"], opened - 1, m["sel"], m["start"], stop))


def _step(s: Column, t: Column) -> Column:
    """The state after one tag."""
    at, level, opened, runs, marks, found = (s[c] for c in ("at", "level", "opened", "runs", "marks", "found"))
    top = F.try_element_at(runs, F.lit(-1))
    selected = t["sel"] > 0

    pushed = F.when(top["name"] == t["name"], F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(
        F.struct(top["name"].alias("name"), (top["n"] + 1).alias("n"))))).otherwise(
        F.concat(runs, F.array(F.struct(t["name"].alias("name"), F.lit(1).alias("n")))))
    marked = F.when(selected, F.concat(marks, F.array(F.struct(
        opened.alias("no"), t["sel"].alias("sel"), at.alias("start"), (level + 1).alias("level"))))).otherwise(marks)
    counted = opened + F.when(selected, 1).otherwise(0)
    after_open = _state(at + 1, level + 1, counted, pushed, marked, found)
    after_empty = _state(at + 1, level, counted, runs, marks, F.when(selected, F.concat(found, F.array(
        _span(opened, opened, t["sel"], at, at)))).otherwise(found))

    # How many runs the end tag reaches down to (0: no such element is open).
    deep = F.when(top["name"] == t["name"], F.lit(1)).otherwise(
        F.coalesce(F.array_position(F.reverse(F.transform(runs, lambda r: r["name"])), t["name"]), F.lit(0)).cast("int"))
    gone = F.aggregate(F.slice(runs, F.size(runs) - deep + 2, deep - 1), F.lit(0), lambda n, r: n + r["n"]) + 1
    below = F.slice(runs, F.lit(1), F.size(runs) - deep)
    hit = F.element_at(runs, F.size(runs) - deep + 1)
    left = F.when(hit["n"] > 1, F.concat(below, F.array(F.struct(hit["name"].alias("name"), (hit["n"] - 1).alias("n"))))).otherwise(below)
    lower = level - F.when(deep == 1, F.lit(1)).otherwise(gone)
    ends = F.coalesce(F.try_element_at(marks, F.lit(-1))["level"] > lower, F.lit(False))
    after_close = _state(
        at + 1, lower, opened, left,
        F.when(ends, F.filter(marks, lambda m: m["level"] <= lower)).otherwise(marks),
        F.when(ends, F.concat(found, _ended(F.filter(marks, lambda m: m["level"] > lower), opened, at))).otherwise(found))
    after_inert = _state(at + 1, level, opened, runs, marks, found)
    return (F.when(t["does"] == 1, after_open).when((t["does"] == -1) & (deep > 0), after_close)
            .when(t["does"] == 2, after_empty).otherwise(after_inert))


def element_spans(tags: Column, selectors: list[tuple[str, str | None]]) -> Column:
    """The spans of all elements that match a selector (tag, class or None), in
    page order."""
    chunks = let(_tag_rows(tags, selectors), lambda rows: F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(rows) / CHUNK).cast("int")), lambda c: F.slice(rows, c * CHUNK + 1, F.lit(CHUNK))))
    no_spans = F.array().cast(f"array<{_SPAN}>")
    zero = F.lit(0)
    start = _state(zero, zero, zero, F.array().cast(f"array<{_RUN}>"), F.array().cast(f"array<{_OPEN}>"), no_spans)
    outer = F.struct(start.alias("s"), F.array().cast(f"array<array<{_SPAN}>>").alias("all"))

    def chunk(state: Column, part: Column) -> Column:
        return let(F.aggregate(part, state["s"], _step), lambda d: F.struct(
            _state(d["at"], d["level"], d["opened"], d["runs"], d["marks"], no_spans).alias("s"),
            F.concat(state["all"], F.array(d["found"])).alias("all")))

    def finish(state: Column) -> Column:
        s = state["s"]
        return F.sort_array(F.concat(F.flatten(state["all"]), _ended(s["marks"], s["opened"], s["at"])))

    return F.aggregate(chunks, outer, chunk, finish)


def page_tree(html_col: Column, selectors: list[tuple[str, str | None]], body) -> Column:
    """``body(tags, texts, spans)`` of a page, which is split once."""
    return let(page_tags(html_col), lambda tags: let(page_texts(html_col), lambda texts: let(
        element_spans(tags, selectors), lambda spans: body(tags, texts, spans))))


def inside(spans: Column, span: Column) -> Column:
    """The spans opened within one of them (itself not)."""
    return F.slice(spans, span["no"] + 2, span["last"] - span["no"])


def matching(spans: Column, selector: int) -> Column:
    return F.filter(spans, lambda e: e["sel"].bitwiseAND(F.lit(1 << selector)) != 0)


def first_matching(spans: Column, selector: int) -> Column:
    return F.try_element_at(matching(spans, selector), F.lit(1))


def element_text(texts: Column, span: Column) -> Column:
    """The element's text: every text node decoded and trimmed, joined without
    a separator; '' for no element."""
    def text(s: Column) -> Column:
        nodes = F.slice(texts, s["start"] + 2, s["stop"] - s["start"])
        return F.array_join(F.transform(nodes, lambda n: strip_py_space(decode_entities(n))), "")

    return F.coalesce(let(span, text), F.lit(""))


# -- the same in tasks ----------------------------------------------------------------------

# TAG with its common first character in front, by which the search skips the text, and
# tags that cannot be scripts or styles tried first; with Java's \z, and its \b, which
# knows all letters while the rest is ASCII.
_TAG = re.compile(r"""(?s)(<(?:/?[a-rt-zA-RT-Z][^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>"""
                  r"""|!--.*?(?:-->|\Z)|(?i:(script|style))(?u:\b).*?(?:</(?i:\2)\s*>|\Z)"""
                  r"""|/?[a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|/?[a-zA-Z][^>]*>|[!?/][^>]*>))""", re.ASCII)
_NAME = re.compile(r"^</?([a-zA-Z][^\s/>]*)", re.ASCII)
_ENTITY = re.compile(ENTITY)
ROWS = pa.list_(pa.struct([pa.field("no", pa.int32()), pa.field("texts", pa.list_(pa.string()))]))


def _character(entity: re.Match) -> str:
    body = entity[0][1:].rstrip(";")
    if body[0] != "#":
        return chr(_NAMES[body]) if body in _NAMES else entity[0]
    code = int(body[2:], 16) if body[1] in "xX" else int(body[1:])
    if code in _WINDOWS:
        return _WINDOWS[code]
    if code == 0xFEFF:  # a byte order mark
        return ""
    return chr(code) if 0 < code < 0xD800 or 0xDFFF < code <= 0x10FFFF else "\ufffd"


def _decoded(text: str) -> str:
    return _ENTITY.sub(_character, text) if "&" in text else text


def tag_reader(selectors: list[tuple[str, str | None]]) -> Callable[[str], tuple[int, str, int]]:
    """What ``_tag_rows`` tells of a tag: (does, name, sel)."""
    tests: dict[str, list] = {}
    for i, (tag, css) in enumerate(selectors):
        tests.setdefault(tag, []).append((1 << i, css, css and re.compile(_class_pattern(css), re.ASCII).search))

    @lru_cache(4096)
    def read(tag: str) -> tuple[int, str, int]:
        named = _NAME.search(tag)
        name = named[1].lower() if named else ""
        if name in ("", "script", "style"):
            return 0, name, 0
        if tag.startswith("</"):
            return -1, name, 0
        bits = 0
        for bit, css, has in tests.get(name, ()):
            if not css or (css in tag and has(tag)):
                bits |= bit
        return (2 if tag.endswith("/>") or name in VOID else 1), name, bits

    return read


class Page:
    """A page's tags, texts and the spans of its selected elements."""

    def __init__(self, source: str, read: Callable[[str], tuple[int, str, int]]):
        parts = _TAG.split(source)  # text, tag, its name if it is a script or style, text, ...
        self.texts, self.tags = parts[0::3], parts[1::3]
        self.spans = spans = []
        stack: list[tuple[str, list | None]] = []
        count: dict[str, int] = defaultdict(int)  # open elements of each name
        for at, (does, name, sel) in enumerate(map(read, self.tags)):
            if does == -1:
                if name not in count or not count[name]:
                    continue
                top = None
                while top != name:
                    top, span = stack.pop()
                    count[top] -= 1
                    if span:
                        span[1], span[4] = len(spans) - 1, at
                continue
            span = None
            if sel:
                span = [len(spans), len(spans), sel, at, at]
                spans.append(span)
            if does == 1:
                stack.append((name, span))
                count[name] += 1
        for _, span in stack:
            if span:
                span[1], span[4] = len(spans) - 1, len(self.tags)

    def find(self, selector: int, within: list | None = None) -> list[list]:
        """The matching spans of the page, or of those inside a span."""
        some = self.spans[within[0] + 1:within[1] + 1] if within else self.spans
        return [s for s in some if s[2] >> selector & 1]

    def first(self, selector: int, within: list | None = None) -> list | None:
        some = self.spans[within[0] + 1:within[1] + 1] if within else self.spans
        for s in some:
            if s[2] >> selector & 1:
                return s
        return None

    def text(self, span: list | None) -> str:
        if span is None:
            return ""
        nodes = self.texts[span[3] + 1:span[4] + 1]
        return _decoded(nodes[0]).strip() if len(nodes) == 1 else "".join([_decoded(t).strip() for t in nodes if t])

    def attribute(self, span: list | None, name: str) -> str:
        got = _attribute_search(name)(self.tags[span[3]]) if span else None
        return _decoded("".join(g or "" for g in got.groups())) if got else ""


@lru_cache(256)
def _attribute_search(name: str) -> Callable[[str], re.Match | None]:
    return re.compile(_attribute_pattern(name), re.ASCII).search


def page_rows(html_col: Column, selectors: list[tuple[str, str | None]], rows: Callable[[Page], list[tuple[int, list[str]]]]) -> Column:
    """array<struct<no, texts>>: what ``rows`` gives for each page's tree."""
    @F.arrow_udf("array<struct<no:int,texts:array<string>>>")
    def run(pages: pa.Array) -> pa.Array:
        read = tag_reader(selectors)
        numbers, ends, texts, text_ends = [], [0], [], [0]
        for source in pages.to_pylist():
            for no, found in rows(Page(source, read)) if source is not None else ():
                numbers.append(no)
                texts += found
                text_ends.append(len(texts))
            ends.append(len(numbers))
        each = pa.StructArray.from_arrays(
            [pa.array(numbers, pa.int32()), pa.ListArray.from_arrays(pa.array(text_ends, pa.int32()), pa.array(texts, pa.string()))],
            fields=list(ROWS.value_type))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each, type=ROWS, mask=pages.is_null() if pages.null_count else None)

    return run(html_col)
