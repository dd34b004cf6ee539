"""Find dataset links and survey elements in collected web pages.

Pages are rows (``page_id, url, html``); a page becomes tokens and elements
(:mod:`berth.functions.html`) inside its row, so there is no shuffle and a page never
meets another page. Which elements count is an argument, a :class:`Selector`; the
defaults are the portal's tree (module items ``li.t`` that hold ``a.ds`` links). Pages
without html have no elements.
"""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from berth.functions.html import count_open, has_class, inside, let, ranges, text_of, tokens


class Selector(NamedTuple):
    """Elements with one of ``tags`` and, if given, the class ``cls`` among theirs."""

    tags: tuple[str, ...]
    cls: str | None = None

    def holds(self, element: Column) -> Column:
        named = element["name"].isin(*self.tags)
        return named if self.cls is None else named & has_class(element["tag"], self.cls)


# ---------------------------------------------------------------------------
# FIXED VALUES — elements and words that the portal crawl looks for.
# ---------------------------------------------------------------------------
NAV = Selector(("nav",))
ANY_LINK = Selector(("a",))
DATASET_LINK = Selector(("a",), "ds")
MODULE_ITEM = Selector(("li",), "t")
MODULE_TITLE = Selector(("span",))
TREE = Selector(("ul", "div"), "treeview")
TREE_FIRST_N = 15
SURVEY_KEYWORDS = ("VBA", "Módulo", "Estado")
SURVEY_FIRST_N = 20
SURVEY_SECTION = "Estadísticas de Medio Ambiente"
SURVEYED_TAGS = ("span", "input", "button", "a", "li", "ul", "nav")
FALLBACK_WORDS = ("Aire", "Agua")
# ---------------------------------------------------------------------------


def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _parsed(pages: DataFrame, *selectors: Selector) -> DataFrame:
    """``page_id``, the page's tokens and, for each selector, its elements ``__e<i>``."""
    d = pages.select("page_id", tokens(F.col("html")).alias("__tok"))
    names = sorted({t for s in selectors for t in s.tags})
    d = d.select("page_id", "__tok", ranges(F.col("__tok"), names).alias("__all"))
    return d.select("page_id", "__tok", *(F.filter("__all", s.holds).alias(f"__e{i}") for i, s in enumerate(selectors)))


def _texts(elements: Column) -> Column:
    return F.transform(elements, lambda e: text_of(F.col("__tok"), e))


def _listed(d: DataFrame, links: Column) -> DataFrame:
    """The trimmed texts of ``links`` in page order, without blanks and repeats."""
    texts = F.filter(F.transform(_texts(links), strip_ws), lambda x: x != "")
    # an outer generator: no filter on the array goes below it, which would build the array again
    d = d.select("page_id", F.posexplode_outer(F.array_distinct(texts)).alias("__p", "text")).where("text is not null")
    return d.select("page_id", (F.col("__p") + 1).cast("bigint").alias("ordinal"), "text")


def discover_links(pages: DataFrame, container: Selector | None = NAV, link: Selector = ANY_LINK) -> DataFrame:
    """``page_id, ordinal, text`` — the texts of the links inside any ``container`` (anywhere
    when it is None), in page order."""
    if container is None:
        return _listed(_parsed(pages, link), F.col("__e0"))
    within = F.filter("__e1", lambda a: F.exists("__e0", lambda c: inside(a, c)))
    return _listed(_parsed(pages, container, link), within)


def discover_module_datasets(pages: DataFrame, module_name: str) -> DataFrame:
    """Dataset links (``a.ds``) of one module of the portal tree: those inside the innermost
    ``li.t`` around the first title span that holds the module's name (in any case) and
    stands in such an item. Links of nested items belong to it."""
    d = _parsed(pages, MODULE_ITEM, MODULE_TITLE, DATASET_LINK)
    titled = F.filter("__e1", lambda s: F.lower(text_of(F.col("__tok"), s)).contains(F.lower(F.lit(module_name))))
    around = F.transform(titled, lambda s: F.try_element_at(F.filter("__e0", lambda i: inside(s, i)), F.lit(-1)))
    item = F.get(F.filter(around, lambda i: i.isNotNull()), 0)
    links = let(item, lambda i: F.filter("__e2", lambda a: F.coalesce(inside(a, i), F.lit(False))))
    return _listed(d, links)


def tree_survey(pages: DataFrame, first_n: int = TREE_FIRST_N) -> DataFrame:
    """Per page: spans inside the (first) tree, and how many of the first
    ``first_n`` are not blank."""
    spans = let(F.get(F.col("__e0"), 0), lambda tree: F.filter("__e1", lambda s: F.coalesce(inside(s, tree), F.lit(False))))
    d = _parsed(pages, TREE, MODULE_TITLE).select("page_id", "__tok", spans.alias("__e"))
    head = _texts(F.slice("__e", 1, first_n))
    return d.select("page_id", F.size("__e").cast("bigint").alias("n_tree_items"),
                    F.size(F.filter(head, lambda x: strip_ws(x) != "")).cast("bigint").alias("n_nonblank_head"))


def element_survey(pages: DataFrame, tags: Sequence[str] = SURVEYED_TAGS) -> DataFrame:
    """``page_id`` plus one ``n_<tag>`` count per surveyed tag (static HTML)."""
    d = pages.select("page_id", tokens(F.col("html")).alias("__tok"))
    return d.select("page_id", *[count_open(F.col("__tok"), t).alias(f"n_{t}") for t in tags])


def _element_texts(pages: DataFrame, tag: str) -> DataFrame:
    """``page_id, __e``: the texts of all elements of one tag."""
    return _parsed(pages, Selector((tag,))).select("page_id", _texts(F.col("__e0")).alias("__e"))


def _contains_any(c: Column, words: Sequence[str]) -> Column:
    cond = F.lit(False)
    for w in words:
        cond = cond | c.contains(w)
    return cond


def keyword_survey(pages: DataFrame, tag: str = "span", keywords: Sequence[str] = SURVEY_KEYWORDS,
                   first_n: int = SURVEY_FIRST_N, section: str = SURVEY_SECTION) -> DataFrame:
    """Per page: number of ``tag`` elements, how many of the first ``first_n``
    contain one of ``keywords``, how many of those are non-blank, and how
    many elements in all mention ``section``."""
    d = _element_texts(pages, tag)
    head = F.slice(F.col("__e"), 1, first_n)
    return d.select(
        "page_id",
        F.size("__e").cast("bigint").alias("n_elements"),
        F.size(F.filter(head, lambda x: _contains_any(x, keywords))).cast("bigint").alias("n_keyword_hits"),
        F.size(F.filter(head, lambda x: strip_ws(x) != "")).cast("bigint").alias("n_nonblank_head"),
        F.size(F.filter("__e", lambda x: x.contains(section))).cast("bigint").alias("n_section"),
    )


def _containing(idx: Column, needle: Column) -> Column:
    return F.filter(idx, lambda s: F.lower(s["t"]).contains(F.lower(needle)))


def module_element(pages: DataFrame, module_names: Sequence[str], tag: str = "span") -> DataFrame:
    """``page_id, module, ordinal, text, how`` — which element opens each
    module: the first whose text contains the module name (any case), else
    the first containing a fallback word the module name holds ("Aire",
    then "Agua"); ``how`` is ``exact``, ``fallback`` or ``none``."""
    d = _element_texts(pages, tag)
    mods = F.array(*[F.lit(m) for m in module_names])
    d = d.select("page_id", "__e", F.explode(mods).alias("module"))
    idx = F.zip_with(F.col("__e"), F.sequence(F.lit(1), F.greatest(F.size("__e"), F.lit(1))),
                     lambda t, i: F.struct(i.alias("i"), t.alias("t")))
    d = d.select("page_id", "module", idx.alias("__idx"))
    exact = _containing(F.col("__idx"), F.col("module"))
    fb = F.array().cast("array<struct<i:int,t:string>>")
    for w in FALLBACK_WORDS:
        fb = F.when(F.col("module").contains(w) & (F.size(fb) == 0),
                    _containing(F.col("__idx"), F.lit(w))).otherwise(fb)
    d = d.select("page_id", "module", exact.alias("__x"), fb.alias("__f"))
    pick = F.coalesce(F.try_element_at("__x", F.lit(1)), F.try_element_at("__f", F.lit(1)))
    how = (F.when(F.size("__x") > 0, F.lit("exact"))
           .when(F.size("__f") > 0, F.lit("fallback")).otherwise(F.lit("none")))
    return d.select("page_id", "module", pick["i"].cast("bigint").alias("ordinal"),
                    pick["t"].alias("text"), how.alias("how"))
