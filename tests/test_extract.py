import math
import random

from pyspark.sql import functions as F

from tidewater.sources import extract as X


def pages(spark, *htmls):
    return spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "page_id long, html string")


def test_table_rows_skip_header_short_rows_and_second_table(spark):
    html = ('<table class="solutions-table"><tr><th>h</th></tr>'
            "<tr><td>1</td><td>2</td><td>3</td><td>4</td><td>5</td></tr>"
            "<tr><td> A <b>B</b>&amp;</td><td>V</td><td>1.0</td><td>2020</td><td>ok</td><td>x</td></tr>"
            "</table>"
            '<table class="solutions-table"><tr><th>h</th></tr>'
            "<tr><td>z</td><td>z</td><td>z</td><td>z</td><td>z</td><td>z</td></tr></table>")
    rows = X.extract_table_rows(pages(spark, html)).collect()
    assert [(r.name, r.vendor, r.version, r.registration_date, r.status) for r in rows] == [
        ("AB&", "V", "1.0", "2020", "ok")]
    assert rows[0].category == "SCM" and rows[0].is_domestic is True


def test_cards_skip_untitled_and_default_missing_fields(spark):
    html = ('<div class="measure-card"><div class="measure-amount">5</div></div>'
            '<div class="measure-card"><h3 class="measure-title"> T1 </h3>'
            '<div class="measure-amount">1 234,50 ₽</div></div>'
            '<div class="measure-card"><h3 class="measure-title">T2</h3>'
            '<div class="measure-description"><span>D</span></div></div>')
    rows = X.extract_fields(pages(spark, html), **X.SUPPORT_CARD).orderBy("block_no").collect()
    assert [(r.title, r.description, r.amount, r.requirements) for r in rows] == [
        ("T1", "", 1234.5, ""), ("T2", "D", 0.0, "")]


def test_links_skip_empty_titles_and_scripts(spark):
    html = ('<script>var s="<li><a href=\\"/x\\">bad</a></li>";</script>'
            '<ul><li><a href="/a">A</a></li><li><a href="/b"> </a></li></ul>')
    rows = X.extract_links(pages(spark, html), base_url="https://h").collect()
    assert [(r.title, r.url) for r in rows] == [("A", "https://h/a")]


def test_json_region_missing_vs_null_and_no_data(spark):
    bodies = ['{"data":[{"year":"2020","value":"1.5","unit":"u"},'
              '{"year":"2021","value":"2","unit":"u","region":null},'
              '{"year":"x","value":"3","unit":"u","region":"M"}]}',
              '{"x":1}']
    df = spark.createDataFrame([("I", b) for b in bodies], "indicator string, body string")
    rows = X.json_indicators(df).collect()
    assert [(r.year, r.value, r.region) for r in rows] == [
        (2020, 1.5, X.DEFAULT_REGION), (2021, 2.0, None), (None, 3.0, "M")]


def test_keyword_overlap_gives_two_rows(spark):
    docs = spark.createDataFrame([(1, "The WMS and the TMS"), (2, "nothing")], "doc_id long, text string")
    rows = X.keyword_hits(docs, ["wms", "tms", "scm"]).orderBy("keyword").collect()
    assert [(r.doc_id, r.keyword, r.hits) for r in rows] == [(1, "tms", 1), (1, "wms", 1)]


def test_top_n_per_group_equals_brute_force(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("aab"), i, rnd.randint(0, 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, id long, v long")
    got = X.top_n_per_group(df, ["g"], [F.col("v").desc(), F.col("id").asc()], 10, "id", 16)
    got = sorted((r.g, r.id, r.rank) for r in got.collect())
    want = []
    for g in set(r[0] for r in rows):
        ranked = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))[:10]
        want += [(g, r[1], i + 1) for i, r in enumerate(ranked)]
    assert got == sorted(want)


def test_recent_rows_strict(spark):
    df = spark.createDataFrame([(1, "2024-01-22 23:59:59"), (2, "2024-01-23 00:00:01")],
                               "id long, t string").withColumn("t", F.to_timestamp_ntz("t"))
    rows = X.recent_rows(df, "t", "2024-01-30", 7).collect()
    assert [r.id for r in rows] == [2]


def test_procurement_blocks(spark):
    html = ('<div class="search-registry-entry-block"><a class="registry-entry__body-title" '
            'href="/epz/1">WMS <b>supply</b></a><div class="registry-entry__body-value">ACME</div>'
            '<div class="price-block__value">1 500,00 ₽</div><div class="data-block__value">01.02.2024'
            '</div></div>'
            '<div class="search-registry-entry-block"><div class="registry-entry__body-value">x</div></div>'
            '<div class="search-registry-entry-block"><a class="registry-entry__body-title">T</a></div>')
    rows = X.procurement_blocks(pages(spark, html), "https://h").orderBy("block_no").collect()
    assert [(r.title, r.url, r.customer, r.price, r.publication_date, r.source) for r in rows] == [
        ("WMSsupply", "https://h/epz/1", "ACME", 1500.0, "01.02.2024", "eis"),
        ("T", "https://h", "", 0.0, "", "eis")]


def test_scope_filter_equality_and_membership(spark):
    df = spark.createDataFrame([("scm", "active", "44"), ("scm", "closed", "223"), ("it", "active", "615")],
                               "category string, status string, law string")
    rows = X.scope_filter(df, category="scm", law=["44", "223", "615", "94"]).collect()
    assert sorted(r.status for r in rows) == ["active", "closed"]
    assert X.scope_filter(df, status="active", category="it").count() == 1


def test_cards_with_wrappers_other_classes_and_quotes(spark):
    html = ("<div class='measure-card wide'><div class=\"head\"><h3 class='big measure-title'>T</h3></div>"
            "<div class='measure-amount'>5</div></div>")
    r = X.extract_fields(pages(spark, html), **X.SUPPORT_CARD).collect()
    assert [(x.title, x.amount) for x in r] == [("T", 5.0)]


def test_relevance_counts_rarity_and_length(spark):
    texts = ["wms " + "x " * 50, "wms wms", "the the the the", "the wms", None, "the", "plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = X.keyword_relevance(docs, ["wms", "the"], 2).collect()
    got = {(r.keyword, r["rank"]): (r.doc_id, r.hits) for r in rows}
    assert got == {("wms", 1): (1, 2), ("wms", 2): (3, 1), ("the", 1): (2, 4), ("the", 2): (5, 1)}
    mean = sum(len(t) for t in texts if t) / 6
    for r in rows:
        idf = math.log((6 - 3 + 0.5) / (3 + 0.5) + 1)
        want = idf * r.hits * 2.2 / (r.hits + 1.2 * (0.25 + 0.75 * len(texts[r.doc_id]) / mean))
        assert abs(r.score - want) < 1e-7
