"""The element tree against a plain stack builder on top of html.parser."""
import random
import re
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tidewater.functions import markup as M
from tidewater.sources import extract as X


class Builder(HTMLParser):
    """Elements as [tag, attrs, text nodes]; texts go to every open element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.found, self.fresh = [], [], True

    def handle_starttag(self, tag, attrs):
        element = [tag, dict(attrs), []]
        self.found.append(element)
        if tag not in M.VOID:
            self.stack.append(element)
        self.fresh = True

    def handle_startendtag(self, tag, attrs):
        self.found.append([tag, dict(attrs), []])
        self.fresh = True

    def handle_endtag(self, tag):
        if any(e[0] == tag for e in self.stack):
            while self.stack.pop()[0] != tag:
                pass
        self.fresh = True

    def handle_comment(self, data):
        self.fresh = True

    def handle_data(self, data):
        if self.stack and self.stack[-1][0] in ("script", "style"):
            return
        for e in self.stack:
            if self.fresh or not e[2]:
                e[2].append(data)
            else:
                e[2][-1] += data
        self.fresh = False


def tree(page, tag, css_class=None):
    b = Builder()
    b.feed(page)
    b.close()
    return ["".join(n.strip() for n in nodes) for t, attrs, nodes in b.found
            if t == tag and (css_class is None or css_class in (attrs.get("class") or "").split())]


def texts(spark, pages, selectors, pick):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    cut = df.select("page_id", M.page_tags(F.col("html")).alias("tags"), M.page_texts(F.col("html")).alias("texts"))
    cut = cut.withColumn("spans", M.element_spans(F.col("tags"), selectors))
    out = cut.select("page_id", F.transform(M.matching(F.col("spans"), pick), lambda e: M.element_text(F.col("texts"), e)).alias("t"))
    return [r.t for r in out.orderBy("page_id").collect()]


def random_page(rnd, size):
    parts = []
    for _ in range(size):
        parts.append(rnd.choice([
            "<div>", "<DIV class='a b'>", '<div class="b">', "<div class=a id=x>", "</div>", "</div>", "<p>", "</p>", "<li>",
            "<td class='x a'>", "</td>", "<br>", "<br/>", "<img alt=\"a > b\">", "<span/>", "</span>", "<b>", "</b>", " x ", "y&amp;z",
            "&#8381;", "&laquo;q&raquo;", "&eacute;", "&#x41;", "\n", "1 < 2", "<!-- <div class='a'> -->", "<div data-c='a'>",
            "<script>var s = '<div class=\"a\">';</script>", "<style>p {}</style>", "&nbsp;n", "text"]))
    return "".join(parts)


@pytest.mark.parametrize("seed", range(3))
def test_elements_and_texts_equal_a_stack_builder(spark, seed):
    rnd = random.Random(seed)
    pages = [random_page(rnd, rnd.randint(0, 60)) for _ in range(80)] + [random_page(rnd, 700), "", "plain", "<div class='a'>open"]
    for pick, selector in enumerate(selectors := [("div", "a"), ("td", None), ("div", None), ("br", None)]):
        got = texts(spark, pages, selectors, pick)
        assert got == [tree(p, *selector) for p in pages]


def test_entities(spark):
    cases = {"a&amp;b": "a&b", "&#8381;": "₽", "&#x20BD;": "₽", "&laquo;x&raquo;&eacute;": "«x»é", "&unknown; &": "&unknown; &",
             "&#128512;": "😀", "&#150;": "–", "&#0;&#xD800;": "��", "no entity": "no entity", "&amp;lt;": "&lt;", "a&b;c": "a&b;c"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.d for r in df.select("t", M.decode_entities(F.col("t")).alias("d")).collect()} == cases


def card(body):
    return f'<div class="measure-card"><h3 class="measure-title">T</h3>{body}</div>'


def cards(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    return X.extract_fields(df, **X.SUPPORT_CARD).orderBy("page_id", "block_no").collect()


def test_nested_elements_and_fields_outside_the_block(spark):
    got = cards(
        spark,
        card('<div class="measure-description"><div>a</div><div>b</div></div>'),
        card("") + '<div class="measure-amount">99</div>',
        card('<div class="measure-amount">1 500,50 &#8381;</div>'),
        card('<div class="measure-description">&laquo;x&raquo;&eacute;</div>'),
        card(card('<div class="measure-amount">7</div>').replace(">T<", ">U<")),
        "<section><div class=measure-card><h3 class=measure-title>one</section><h3 class='measure-title'>two</h3>")
    assert [(r.page_id, r.block_no, r.title, r.description, r.amount) for r in got] == [
        (0, 0, "T", "ab", 0.0), (1, 0, "T", "", 0.0), (2, 0, "T", "", 1500.5), (3, 0, "T", "«x»é", 0.0),
        (4, 0, "T", "", 7.0), (4, 1, "U", "", 7.0), (5, 0, "one", "", 0.0)]


def test_a_table_nested_in_a_cell(spark):
    row = "".join(f"<td>{i}</td>" for i in range(6))
    inner = f"<table><tr>{row}</tr></table>"
    page = f"<table class='wide solutions-table'><tr><th>h</th></tr><tr>{row.replace('<td>0', '<td>x' + inner)}</tr></table>"
    rows = X.extract_table_rows(spark.createDataFrame([(1, page)], "page_id long, html string")).orderBy("row_no").collect()
    assert [(r.row_no, r.name, r.status) for r in rows] == [(1, "x012345", "3"), (2, "0", "4")]


def test_attributes_of_the_title_link(spark):
    page = ("<div class='search-registry-entry-block'><div class='registry-entry__body-value'><i>A</i>&amp;B</div>"
            "<a title='href=no' class='registry-entry__body-title' href='/x?a=1&amp;b=2'>t</a></div>")
    r = X.procurement_blocks(spark.createDataFrame([(1, page)], "page_id long, html string"), "https://h").first()
    assert (r.url, r.customer) == ("https://h/x?a=1&b=2", "A&B")


def test_time_follows_the_page_size(spark):
    """Deep nesting and many cards: four times the page takes less than ten times as long."""
    def seconds(page):
        df = spark.createDataFrame([(1, page)] * 4, "page_id long, html string").repartition(1)
        X.extract_fields(df, **X.SUPPORT_CARD).count()
        t = time.perf_counter()
        X.extract_fields(df, **X.SUPPORT_CARD).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    for make in (lambda n: card("<div>" * n + "x" + "</div>" * n), lambda n: card("<div class='measure-amount'>5</div>") * n):
        small, large = seconds(make(1500)), seconds(make(6000))
        assert large < 10 * small + 1


def test_rows_taken_in_tasks_equal_the_columns(spark):
    """``page_rows`` and the column form give the same texts of the same elements."""
    rnd = random.Random(9)
    odd = ["&#65279;x", "&#0;&#xD800;&#128512;&#150;&unknown;&copy;", "<td class=a>  q </td></td></p>", "<scriptй class='a'>z</scriptй>",
           "<DIV\tCLASS='b a'>&lt;</DIV >", "<td><script>x", "<!-- <td>", "<div class='A'>n</div>", "<div class=\"xa\">n</div>", "</div>"]
    pages = [random_page(rnd, rnd.randint(0, 60)) + rnd.choice(odd) + random_page(rnd, 3) for _ in range(120)] + odd + ["", None]
    selectors = [("div", "a"), ("td", None), ("br", None), ("div", None)]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")

    def rows(page):
        return [(s[0], [page.text(s), page.attribute(s, "class")]) for s in page.find(0) + page.find(1) + page.find(2)]

    got = df.select("page_id", M.page_rows(F.col("html"), selectors, rows).alias("r"))
    want = df.select("page_id", M.page_tree(F.col("html"), selectors, lambda tags, texts, spans: F.flatten(F.array(*[
        F.transform(M.matching(spans, k), lambda e: F.struct(e["no"].alias("no"), F.array(
            M.element_text(texts, e), M.attribute(F.element_at(tags, e["start"] + 1), "class")).alias("texts"))) for k in range(3)]))).alias("r"))
    got, want = ({r.page_id: [tuple(x) for x in r.r or []] for r in d.collect()} for d in (got, want))
    assert got == want and sum(map(len, got.values())) > 500


def test_pages_of_one_file_are_read_by_many_tasks(spark, tmp_path):
    """One file is one scan task; the pages made of it are not left to it."""
    from tidewater.sources import pages as PG

    spark.range(400).selectExpr("id o_orderkey", "id % 5 o_custkey", "'P' o_orderstatus", "1.5 o_totalprice", "timestamp'2020-01-01' o_orderdate",
                                "'1-URGENT' o_orderpriority").coalesce(1).write.parquet(f"{tmp_path}/o")
    spark.range(5).selectExpr("id c_custkey", "'c' c_name").coalesce(1).write.parquet(f"{tmp_path}/c")
    pages = PG.procurement_pages(spark.read.parquet(f"{tmp_path}/o"), spark.read.parquet(f"{tmp_path}/c"))
    rows = X.procurement_blocks(pages, "").withColumn("task", F.spark_partition_id())
    assert rows.select("page_id").distinct().count() == 400
    assert rows.select("task").distinct().count() > 4


def test_markup_is_split_as_its_expression_says():
    """The tag expression of the tasks finds what TAG finds, odd and open tags too."""
    plain = re.compile(M.TAG.replace(r"\z", r"\Z").replace(r"\b", r"(?u:\b)"), re.ASCII)
    rnd = random.Random(5)
    parts = ["<", "</", ">", "<!--", "-->", "script", "STYLE", "scriptй", "div", " class='a", ' id="b>c"', "'", '"', "/>", "ſtyle", "\n", "!",
             "</Script >", "</style>", "<td>", "</td>", "x"]
    for _ in range(5000):
        page = M.Page(text := "".join(rnd.choices(parts, k=rnd.randint(0, 25))), M.tag_reader([("td", None)]))
        assert page.tags == [m[0] for m in plain.finditer(text)]
        assert "".join(t + g for t, g in zip(page.texts, [*page.tags, ""])) == text


def test_page_rows_keep_null_and_empty_pages(spark):
    df = spark.createDataFrame([(1, "<td>a</td><td>b</td>"), (2, None), (3, ""), (4, "<td> c")], "page_id long, html string").repartition(1)
    got = df.select("page_id", M.page_rows(F.col("html"), [("td", None)], lambda p: [(s[0], [p.text(s)]) for s in p.find(0)]).alias("r"))
    assert {r.page_id: r.r and [tuple(x) for x in r.r] for r in got.collect()} == {
        1: [(0, ["a"]), (1, ["b"])], 2: None, 3: [], 4: [(0, ["c"])]}


def test_events_of_one_file_are_rendered_by_many_tasks_and_parsed_once(spark, tmp_path):
    """The payloads made of one file are not left to its one task, and an event's JSON is read once."""
    from tidewater.sources import pages as PG
    from tidewater.sources import testdata as TD

    spark.range(400).selectExpr("id event_id", "'e' event_type", "id % 7 user_id", "1.5D value", "timestamp'2020-01-01' ts",
                                "concat('{\"k\":', id % 30, '}') props").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    events = spark.read.parquet(f"{tmp_path}/events.parquet")
    rows = X.json_indicators(PG.indicator_payloads(events)).withColumn("task", F.spark_partition_id())
    assert rows.count() == 400 and rows.select("task").distinct().count() > 4
    for df in (PG.indicator_payloads(events), TD.support_measures(spark, str(tmp_path))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("get_json_object") == 1
