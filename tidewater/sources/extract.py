"""Extraction jobs: fetched pages and payloads to rows (S1-S10).

All of them are narrow transformations over a table of pages (one row per
fetched document), so they parallelise by page and never shuffle, except
the per-keyword top-k, which is two-phase to survive a hot keyword.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.functions import markup as M
from tidewater.functions.columns import html_text, parse_money, strip_scripts

# The default region of an indicator row with no region key,
# and the provenance tag each source writes into its rows' ``source`` column.
DEFAULT_REGION = "Российская Федерация"
SOURCE_TAGS = {"registry": "reestr_po", "procurement": "eis", "statistics": "fedstat",
               "support": "gisp"}


def from_trees(pages: DataFrame, selectors: list[tuple[str, str | None]], rows) -> DataFrame:
    """page_id and ``_r`` (no, texts) for each of the ``rows(page)`` of a page's
    element tree. Pages without the class of the first selector are not split at
    all."""
    marker = selectors[0][1]
    some = pages.filter(F.contains("html", F.lit(marker))) if marker else pages
    return some.select("page_id", F.explode(M.page_rows(F.col("html"), selectors, rows)).alias("_r"))


# -- S1: HTML table -> rows --------------------------------------------------------------

TABLE_FIELDS = ["name", "vendor", "version", "registration_date", "status"]


def extract_table_rows(pages: DataFrame, css_class: str = "solutions-table",
                       min_cells: int = 6, source: str = SOURCE_TAGS["registry"]) -> DataFrame:
    """First ``table.css_class`` of each page; header row skipped; rows (those of
    nested tables too) with at least ``min_cells`` cells give name, vendor, version, registration date,
    status (cells 0-4), plus the constant columns of the registry source."""
    def rows(page: M.Page) -> list[tuple[int, list[str]]]:
        table, out = page.first(0), []
        for no, tr in enumerate(page.find(1, table) if table else []):
            cells = page.find(2, tr)
            if no and len(cells) >= min_cells:
                out.append((no, [page.text(c) for c in cells[:len(TABLE_FIELDS)]]))
        return out

    out = from_trees(pages, [("table", css_class), ("tr", None), ("td", None)], rows)
    return out.select(
        "page_id", F.col("_r.no").alias("row_no"),
        *[F.col("_r.texts")[i].alias(n) for i, n in enumerate(TABLE_FIELDS)],
        F.lit("SCM").alias("category"), F.lit(True).alias("is_domestic"),
        F.lit(source).alias("source"))


# -- S2: link / entry blocks -> rows --------------------------------------------------------

LINK_ITEM = r'(?is)<li\b[^>]*>\s*<a\b[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>'


def extract_links(pages: DataFrame, base_url: str = "", source: str = "pages") -> DataFrame:
    """Each ``<li><a href>`` item: title (tag-free text) and ``base_url + href``;
    an item without title text is skipped, as the reference skips a block
    without a title."""
    html = strip_scripts(F.col("html"))
    items = F.regexp_extract_all(html, F.lit(LINK_ITEM), F.lit(0))
    out = pages.select("page_id", F.posexplode(items).alias("item_no", "item"))
    return (out.select(
        "page_id", "item_no",
        html_text(F.regexp_extract("item", LINK_ITEM, 2)).alias("title"),
        F.concat(F.lit(base_url), F.regexp_extract("item", LINK_ITEM, 1)).alias("url"),
        F.lit(source).alias("source"))
        .filter(F.col("title") != ""))


# -- S3 / S4: cards with optional fields -------------------------------------------------------

def extract_fields(pages: DataFrame, block: tuple[str, str], required: tuple[str, str, str],
                   fields: dict[str, tuple[str, str]], money_fields: tuple[str, ...] = (),
                   source: str = SOURCE_TAGS["support"],
                   attr_fields: dict[str, tuple[str, str, str, str]] | None = None) -> DataFrame:
    """Each ``block`` element (tag, class) of a page becomes a row when its
    ``required`` (name, tag, class) element exists; other fields are the text
    of their first (tag, class) element or ''; money fields are parsed (0
    when absent or unparsable); ``attr_fields`` name -> (tag, class,
    attribute, prefix) take ``prefix + attribute value`` of the first such
    element ('' value when the attribute is missing)."""
    req_name, *req = required
    attr_fields = attr_fields or {}
    wanted = [block, tuple(req), *fields.values(), *[(tag, cls) for tag, cls, _, _ in attr_fields.values()]]
    selectors = list(dict.fromkeys(wanted))
    at = selectors.index

    block_at, title_at, texts_at = at(block), at(tuple(req)), [at(f) for f in fields.values()]
    links_at = [(at((tag, cls)), name, prefix) for tag, cls, name, prefix in attr_fields.values()]

    def rows(page: M.Page) -> list[tuple[int, list[str]]]:
        out = []
        for no, card in enumerate(page.find(block_at)):
            if title := page.first(title_at, card):
                texts = [page.text(page.first(i, card)) for i in texts_at]
                links = [prefix + page.attribute(page.first(i, card), name) for i, name, prefix in links_at]
                out.append((no, [page.text(title), *texts, *links]))
        return out

    names = [req_name, *fields, *attr_fields]
    texts = [F.get("_r.texts", F.lit(i)) for i in range(len(names))]
    return from_trees(pages, selectors, rows).select("page_id", F.col("_r.no").alias("block_no"), *[
        (parse_money(t) if n in money_fields else t).alias(n) for n, t in zip(names, texts)], F.lit(source).alias("source"))


SUPPORT_CARD = dict(
    block=("div", "measure-card"),
    required=("title", "h3", "measure-title"),
    fields={"description": ("div", "measure-description"),
            "amount": ("div", "measure-amount"),
            "deadline": ("div", "measure-deadline"),
            "requirements": ("div", "measure-requirements")},
    money_fields=("amount",),
)


# The selectors of a procurement search result block.
PROCUREMENT_BLOCK = dict(
    block=("div", "search-registry-entry-block"),
    required=("title", "a", "registry-entry__body-title"),
    fields={"customer": ("div", "registry-entry__body-value"),
            "price": ("div", "price-block__value"),
            "publication_date": ("div", "data-block__value")},
    money_fields=("price",),
    source=SOURCE_TAGS["procurement"],
)


def procurement_blocks(pages: DataFrame, base_url: str) -> DataFrame:
    """S2 on result pages: title, ``base_url + href`` of the title link,
    customer ('' when absent), price (0 when absent), publication date. The
    ``keyword`` that a page was found by goes with each of its rows (null for
    pages without that column)."""
    keyword = F.col("keyword") if "keyword" in pages.columns else F.lit(None).cast("string").alias("keyword")
    keyed = pages.select(F.struct("page_id", keyword).alias("page_id"), "html")
    rows = extract_fields(keyed, **PROCUREMENT_BLOCK,
                          attr_fields={"url": ("a", "registry-entry__body-title", "href", base_url)})
    return rows.select("page_id.page_id", "page_id.keyword", *[c for c in rows.columns if c != "page_id"])


# -- S6: JSON payload -> rows -----------------------------------------------------------------

def json_indicators(payloads: DataFrame, indicator_col: str = "indicator",
                    body_col: str = "body") -> DataFrame:
    """``{"data": [{year, value, unit, region}, ...]}`` to rows.

    A payload without ``data`` gives no rows. ``region`` takes the default only
    when the key is missing; an explicit JSON null stays NULL.
    """
    parsed = F.from_json(F.col(body_col), "struct<data:array<map<string,string>>>")
    out = payloads.select(indicator_col, F.explode(parsed["data"]).alias("m"))
    region = F.when(F.map_contains_key("m", "region"), F.col("m")["region"]).otherwise(
        F.lit(DEFAULT_REGION))
    return out.select(
        F.col(indicator_col).alias("indicator"),
        F.col("m")["year"].try_cast("long").alias("year"),
        F.col("m")["value"].try_cast("double").alias("value"),
        F.col("m")["unit"].alias("unit"),
        region.alias("region"),
        F.lit(SOURCE_TAGS["statistics"]).alias("source"))


# -- S7 / S8: keyword search ------------------------------------------------------------------

def keyword_hits(docs: DataFrame, keywords: list[str], text_col: str = "text",
                 id_col: str = "doc_id", keep: tuple[Column, ...] = ()) -> DataFrame:
    """One row per (document, keyword) whose lower-cased text contains the
    keyword; a document matching two keywords gives two rows. ``keep`` names
    more columns of the documents to go with the rows.

    The keyword list is a literal array filtered per document: no join, no
    shuffle; each text is lower-cased once and scanned in full.
    """
    kws = F.array(*[F.lit(k.lower()) for k in keywords])
    low = F.lower(F.col(text_col))
    with_low = docs.select(id_col, low.alias("_low"), *keep)
    kept = [c for c in with_low.columns if c not in (id_col, "_low")]
    hits = with_low.select(id_col, "_low", *kept,
                           F.explode(F.filter(kws, lambda k: F.contains(F.col("_low"), k)))
                           .alias("keyword"))
    n = ((F.length("_low") - F.length(F.replace(F.col("_low"), F.col("keyword"), F.lit(""))))
         / F.length("keyword")).cast("long")
    return hits.select(id_col, "keyword", n.alias("hits"), *kept)


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int,
                    salt_col: str, salt_buckets: int = 64) -> DataFrame:
    """Exact top-n per group in two phases.

    Phase 1 ranks inside (group, salt) sub-groups, so a group holding a third
    of the rows is spread over ``salt_buckets`` tasks; phase 2 ranks the at
    most ``n * salt_buckets`` survivors per group.
    """
    salt = F.pmod(F.xxhash64(F.col(salt_col)), F.lit(salt_buckets))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    local = (df.withColumn("_salt", salt).withColumn("_r", F.row_number().over(w1))
             .filter(F.col("_r") <= n).drop("_r", "_salt"))
    w2 = Window.partitionBy(*group).orderBy(*order)
    return local.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= n)


def keyword_top(hits: DataFrame, n: int = 10, id_col: str = "doc_id") -> DataFrame:
    return top_n_per_group(hits, ["keyword"], [F.col("hits").desc(), F.col(id_col).asc()], n,
                           salt_col=id_col)


def keyword_relevance(docs: DataFrame, keywords: list[str], n: int = 10, text_col: str = "text", id_col: str = "doc_id",
                      k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The ``n`` most relevant documents per keyword by BM25: how often the
    keyword stands in the text, how rare it is in the collection, and how long
    the text is against the mean. Ties by id.

    The collection's size and mean length are scalars of the plan; a keyword's
    document frequency is one row per keyword of the list. The ranking is
    two-phase with a salt, as for ``keyword_top``.
    """
    known = docs.filter(F.col(text_col).isNotNull())
    n_docs = known.agg(F.count("*")).scalar()
    mean = known.agg(F.sum(F.length(text_col)) / F.count("*")).scalar()
    hits = keyword_hits(known, keywords, text_col, id_col, (F.length(text_col).alias("n_chars"),))
    found = hits.groupBy("keyword").agg(F.count("*").alias("df"))  # a row per keyword of the list
    idf = F.log((n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0)
    weight = F.col("hits") * (k1 + 1.0) / (F.col("hits") + k1 * (1.0 - b + b * F.col("n_chars") / mean))
    scored = hits.join(F.broadcast(found), "keyword").select(id_col, "keyword", "hits", F.round(idf * weight, 8).alias("score"))
    return top_n_per_group(scored, ["keyword"], [F.col("score").desc(), F.col(id_col).asc()], n, salt_col=id_col)


# -- S9 / S10: scope and recency filters --------------------------------------------------------

def scope_filter(df: DataFrame, **equals) -> DataFrame:
    """Request scope (category, status, law flags) as column filters; a list
    value means membership."""
    for c, v in equals.items():
        df = df.filter(F.col(c).isin(v) if isinstance(v, (list, tuple)) else F.col(c) == v)
    return df


def recent_rows(df: DataFrame, ts_col: str, as_of: str, days_back: int) -> DataFrame:
    """Rows newer than ``as_of - days_back`` days (the declared ``days_back``)."""
    cutoff = F.to_timestamp(F.lit(as_of)) - F.make_interval(days=F.lit(days_back))
    return df.filter(F.col(ts_col) > cutoff.cast(df.schema[ts_col].dataType))
