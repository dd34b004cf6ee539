"""HTML in Spark expressions: a page as an array of tokens, elements as token ranges.

``tokens`` cuts a page by one pattern whose repeats are all possessive (no backtracking
and no recursion, however many attributes a tag has). ``ranges`` folds the tags over a
stack of open elements. Both work inside a row, so a page never leaves its task.

What the tokens follow:

* comments, declarations and processing instructions are no text and hold no tags;
* a ``>`` inside a quoted attribute value doesn't end its tag; a quote that never closes is
  no quote; a tag that never ends is dropped;
* what stands in ``script``, ``style``, ``textarea`` and ``title`` is text up to their end tag;
* character references end in ``;``: decimal, hexadecimal (0x80-0x9F as browsers read
  them, impossible code points as U+FFFD) and the 252 names of HTML 4; others stay as written.

What the ranges follow: an end tag closes the innermost open element of its name and all
that was opened inside; without such an element it is ignored. List items and options also
end where a sibling begins, and are not closed from inside an inner list. What is never
closed ends with the page. Void elements hold nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES — element kinds of the HTML standard.
# ---------------------------------------------------------------------------
RAW_TEXT = ("script", "style", "textarea", "title")
UNDECODED = ("script", "style")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
ENDED_BY_SIBLING = ("li", "option")
ITEM_SCOPE = ("ul", "ol", "select", "table", "td", "th", "nav", "section", "button", "body")
# ---------------------------------------------------------------------------

_ATTRS = r"""(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+"""
_TOKEN = ("(?s)("
          r"<!--(?:-?>|.*?(?:--!?>|\z))"
          rf"|<((?i:{'|'.join(RAW_TEXT)}))(?=[\s/>]){_ATTRS}>.*?(?=(?i:</\2)[\s/>]|\z)"
          rf"|</?[a-zA-Z]{_ATTRS}>"
          r"|<[!?/a-zA-Z][^>]*+(?:>|\z)"
          r"|[^<]++|<)")
_NAME = rf"^</?([a-zA-Z][^\s/>]*+){_ATTRS}>"  # of a tag that ends
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"']++)"""
_CLASS = (r"(?is)^<[a-z][^\s/>]*+[\s/]++(?:(?!class\s*+=)[^\s=/>]++(?:\s*+=\s*+" + _VALUE + r"?+)?+[\s/]*+)*+class\s*+=\s*+(" + _VALUE + ")")
_RAW = rf"(?s)^<[a-zA-Z]{_ATTRS}>(.*)$"
_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*+);"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def _character(code: Column) -> Column:
    impossible = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    windows = "".join(bytes([b]).decode("cp1252", errors="ignore") or chr(b) for b in range(0x80, 0xA0))
    exact = F.decode(F.unhex(F.lpad(F.hex(F.when(impossible, 0xFFFD).otherwise(code)), 8, "0")), "UTF-32")
    return F.when(code.between(0x80, 0x9F), F.substring(F.lit(windows), code.cast("int") - 0x7F, F.lit(1))).otherwise(exact)


def _reference(ref: Column) -> Column:
    """The character that ``ref`` (between ``&`` and ``;``) names, or null."""
    names = F.str_to_map(F.lit("\n".join(f"{name}\t{chr(code)}" for name, code in sorted(name2codepoint.items()))), F.lit("\n"), F.lit("\t"))
    hexadecimal = F.conv(F.substring(ref, 3, 6), 16, 10).cast("bigint")
    return (F.when(F.lower(F.left(ref, F.lit(2))) == "#x", _character(hexadecimal))
            .when(F.left(ref, F.lit(1)) == "#", _character(F.substring(ref, 2, 7).cast("bigint")))
            .otherwise(F.try_element_at(names, ref)))


def decoded(text: Column) -> Column:
    """``text`` with its character references replaced, each once."""
    def part(p: Column, i: Column) -> Column:
        whole = F.concat(F.lit("&"), p)
        found = let(F.regexp_extract(p, _REFERENCE, 1), lambda ref: F.when(ref == "", whole).otherwise(
            F.coalesce(F.concat(_reference(ref), F.substring(p, F.char_length(ref) + 2, F.char_length(p))), whole)))
        return F.when(i == 0, p).otherwise(found)
    return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "&"), part), "")).otherwise(text)


def tokens(html: Column) -> Column:
    """Array of ``(kind, name, tag, text)``: kind 1 opens, -1 closes, 0 is text."""
    def token(t: Column) -> Column:
        closes = t.startswith("</")
        raw = lambda n: F.when(n.isin(*UNDECODED), F.regexp_extract(t, _RAW, 1)).when(n.isin(*RAW_TEXT), decoded(F.regexp_extract(t, _RAW, 1)))
        tag = lambda n: F.struct(F.when(n == "", 0).when(closes, -1).otherwise(1).alias("kind"), F.when(n != "", n).alias("name"),
                                 F.when((n != "") & ~closes, t).alias("tag"), F.when(t == "<", t).when(~closes, raw(n)).alias("text"))
        none = F.lit(None).cast("string")
        text = F.struct(F.lit(0).alias("kind"), none.alias("name"), none.alias("tag"), decoded(t).alias("text"))
        return F.when(t.startswith("<"), let(F.lower(F.regexp_extract(t, _NAME, 1)), tag)).otherwise(text)
    return F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_TOKEN), 1), token)


def count_open(toks: Column, name: str) -> Column:
    return F.size(F.filter(toks, lambda t: (t["kind"] == 1) & (t["name"] == name))).cast("bigint")


def ranges(toks: Column, names: Sequence[str]) -> Column:
    """Array of ``(start, stop, name, tag)``, by start: elements called one of ``names``; their content
    is what stands between the tokens at these places (from 0)."""
    tags = F.filter(F.transform(toks, lambda t, i: F.struct(i.alias("at"), t["kind"].alias("kind"), t["name"].alias("name"))),
                    lambda t: (t["kind"] != 0) & ~t["name"].isin(*VOID))
    zero = F.struct(F.array().cast("array<string>").alias("names"), F.array().cast("array<int>").alias("starts"),
                    F.array().cast("array<struct<start:int,stop:int,name:string>>").alias("out"))

    def innermost(open_: Column, name: Column) -> Column:
        return F.when(F.array_contains(open_, name), F.size(open_) - F.array_position(F.reverse(open_), name) + 1).otherwise(0).cast("int")

    def ended(a: Column, k: Column, at: Column) -> Column:
        return F.filter(F.zip_with(F.slice(a["starts"], k, F.size(a["starts"])), F.slice(a["names"], k, F.size(a["names"])),
                                   lambda s, n: F.struct(s.alias("start"), at.cast("int").alias("stop"), n.alias("name"))),
                        lambda x: x["name"].isin(*names))

    def step(a: Column, t: Column) -> Column:
        barrier = F.coalesce(F.array_max(F.transform(a["names"], lambda n, i: F.when(n.isin(*ITEM_SCOPE), i + 1))), F.lit(0))
        item = let(innermost(a["names"], t["name"]), lambda k: F.when(k > barrier, k).otherwise(0))
        cut = F.when(t["name"].isin(*ENDED_BY_SIBLING), item).when(t["kind"] == -1, innermost(a["names"], t["name"])).otherwise(0)
        opened = lambda x, new: F.when(t["kind"] == 1, F.array_append(x, new)).otherwise(x)
        left = lambda x, k: F.when(k == 0, x).otherwise(F.slice(x, F.lit(1), F.greatest(k - 1, F.lit(0))))
        keeps = lambda k: (k == 0) | ((k == F.size(a["names"])) & ~t["name"].isin(*names) & (t["kind"] == -1))
        return let(cut, lambda k: F.struct(
            opened(left(a["names"], k), t["name"]).alias("names"),
            opened(left(a["starts"], k), t["at"]).alias("starts"),
            F.when(keeps(k), a["out"]).otherwise(F.concat(a["out"], ended(a, k, t["at"]))).alias("out")))

    found = F.aggregate(tags, zero, step, lambda a: F.concat(a["out"], ended(a, F.lit(1), F.size(toks))))
    return F.transform(F.sort_array(found), lambda e: F.struct(
        e["start"].alias("start"), e["stop"].alias("stop"), e["name"].alias("name"), F.get(toks, e["start"])["tag"].alias("tag")))


def has_class(tag: Column, name: str) -> Column:
    """Whether ``name`` is one of the classes of an open tag."""
    value = F.regexp_extract(tag, _CLASS, 1)
    bare = F.when(value.rlike("^[\"']"), F.substring(value, F.lit(2), F.char_length(value) - 2)).otherwise(value)
    return F.array_contains(F.split(decoded(bare), r"\s+"), name)


def text_of(toks: Column, element: Column) -> Column:
    """All text inside an element of :func:`ranges`."""
    inside = F.slice(toks, element["start"] + 1, element["stop"] - element["start"])
    return F.array_join(F.transform(inside, lambda t: t["text"]), "")


def inside(element: Column, outer: Column) -> Column:
    return (element["start"] > outer["start"]) & (element["start"] < outer["stop"])
