"""Fetched-document tables derived by Spark from the test tables.

The test data holds web pages, but none with a registry table, support
cards or an indicator payload. These jobs render such documents from the
star-schema rows (one document per row, so the work grows with the data)
and the extraction jobs read them back; the expected values are the source
columns themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(rows: DataFrame, *columns: str) -> DataFrame:
    """These columns of the rows, dealt over the session's shuffle partitions. A
    table of one file (or row group) is read by one task, which would then
    render and parse every page; the narrow rows are cheap to send, pages not."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select(*columns).repartition(n, *columns)


def registry_pages(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """One page per supplier: a header row, a 5-cell row (must be skipped) and
    the supplier's 6-cell row with nested tags and an entity; a second table
    after it must be ignored."""
    s = spread(supplier, "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    s = s.join(nation, s.s_nationkey == nation.n_nationkey)
    status = F.when(F.col("s_acctbal") >= 0, F.lit("active")).otherwise(F.lit("suspended"))
    td = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    row6 = F.concat(
        F.lit("<tr>"),
        td(F.concat(F.lit(" <b>"), F.col("s_name"), F.lit("</b> &amp; Co "))),
        td(F.col("n_name")),
        td(F.concat(F.lit("v"), F.col("s_nationkey").cast("string"))),
        td(F.col("s_acctbal").cast("string")),
        td(status),
        td(F.lit("x")),
        F.lit("</tr>"))
    html = F.concat(
        F.lit('<html><head><script>var t="<tr><td>no</td></tr>";</script></head><body>'
              '<table class="solutions-table"><tr><th>Name</th><th>Vendor</th><th>Version</th>'
              "<th>Date</th><th>Status</th><th>Extra</th></tr>"
              "<tr><td>a</td><td>b</td><td>c</td><td>d</td><td>e</td></tr>"),
        row6,
        F.lit('</table><table class="other"><tr><td>1</td><td>2</td><td>3</td><td>4</td>'
              "<td>5</td><td>6</td></tr></table></body></html>"))
    return s.select(F.col("s_suppkey").alias("page_id"), html.alias("html"))


def money_text(amount) -> F.Column:
    """``1 234,50 ₽``: ASCII-space thousands, decimal comma, rouble sign."""
    s = F.format_number(amount.cast("double"), 2)
    s = F.replace(F.replace(s, F.lit(","), F.lit(" ")), F.lit("."), F.lit(","))
    return F.concat(s, F.lit(" ₽"))


def support_card_pages(support: DataFrame) -> DataFrame:
    """One page per grant with its ``measure-card``; the requirements element is
    always absent (must give ''). Where the grant's roi is a multiple of 7 a
    card without title stands before it (such cards must be skipped)."""
    support = spread(support, "support_id", "program_name", "measure_type", "amount_rub", "disbursement_date", "roi_pct")
    k = F.col("roi_pct").cast("int")
    body = F.concat(
        F.lit('<div class="measure-description"> '), F.col("measure_type"), F.lit(" </div>"),
        F.lit('<div class="measure-amount">'), money_text(F.col("amount_rub")), F.lit("</div>"),
        F.lit('<div class="measure-deadline">'), F.col("disbursement_date").cast("string"), F.lit("</div></div>"))
    card = F.lit('<div class="measure-card">')
    untitled = F.when(k % 7 == 0, F.concat(card, body)).otherwise(F.lit(""))
    html = F.concat(F.lit("<html><body>"), untitled, card, F.lit('<h3 class="measure-title">'),
                    F.col("program_name"), F.lit("</h3>"), body, F.lit("</body></html>"))
    return support.select(F.col("support_id").alias("page_id"), html.alias("html"))


def indicator_payloads(events: DataFrame) -> DataFrame:
    """One JSON payload per event. By k % 3 the region key is missing (0),
    JSON null (1) or a value (2). Where k % 10 == 9 a second payload without
    ``data`` stands beside it (must give no rows)."""
    events = spread(events, "event_id", "event_type", "user_id", "value", "ts", "props").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int"))
    k = F.col("k")
    region = (F.when(k % 3 == 0, F.lit(""))
              .when(k % 3 == 1, F.lit(',"region":null'))
              .otherwise(F.concat(F.lit(',"region":"R'), F.col("user_id").cast("string"), F.lit('"'))))
    item = F.concat(F.lit('{"year":"'), F.year("ts").cast("string"), F.lit('","value":"'),
                    F.col("value").cast("string"), F.lit('","unit":"rub"'), region, F.lit("}"))
    good = F.concat(F.lit('{"data":['), item, F.lit("]}"))
    bodies = F.when(k % 10 == 9, F.array(good, F.lit('{"x":1}'))).otherwise(F.array(good))
    return events.select("event_id", F.col("event_type").alias("indicator"), F.explode(bodies).alias("body"))


def money_strings(lineitem: DataFrame) -> DataFrame:
    """Price texts in three spellings by line number: ASCII-space groups with a
    decimal comma and sign (0), no-break-space groups (1), plain (2)."""
    p = F.col("l_extendedprice")
    plain = F.format_number(p, 2)
    ascii_sp = money_text(p)
    nbsp = F.replace(ascii_sp, F.lit(" "), F.lit("\u00a0"))
    nbsp = F.replace(nbsp, F.lit("\u00a0₽"), F.lit(" ₽"))
    m = F.col("l_linenumber") % 3
    text = (F.when(m == 0, ascii_sp).when(m == 1, nbsp)
            .otherwise(F.replace(plain, F.lit(","), F.lit(""))))
    return lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                           p.alias("price"), text.alias("money_text"))


def procurement_pages(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One search-result page per order with one entry block: linked title,
    customer (left out for status 'P'), price text and publication date. The
    page was found by searching for the order's priority."""
    o = spread(orders, "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    o = o.join(customer.select("c_custkey", "c_name"), o.o_custkey == F.col("c_custkey"))
    cust = F.when(F.col("o_orderstatus") != "P",
                  F.concat(F.lit('<div class="registry-entry__body-value">'), F.col("c_name"),
                           F.lit("</div>"))).otherwise(F.lit(""))
    html = F.concat(
        F.lit('<html><body><div class="search-registry-entry-block">'
              '<a class="registry-entry__body-title" href="/epz/order/'),
        F.col("o_orderkey").cast("string"), F.lit('">Order <b>'), F.col("o_orderpriority"),
        F.lit("</b></a>"), cust,
        F.lit('<div class="price-block__value">'), money_text(F.col("o_totalprice")), F.lit("</div>"),
        F.lit('<div class="data-block__value">'), F.date_format("o_orderdate", "dd.MM.yyyy"),
        F.lit("</div></div></body></html>"))
    return o.select(F.col("o_orderkey").alias("page_id"), F.col("o_orderpriority").alias("keyword"), html.alias("html"))
