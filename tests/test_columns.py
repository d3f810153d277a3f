import pytest
from pyspark.sql import functions as F

from tidewater.functions import columns as C


def one_col(spark, values, expr, typ="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_round_half_even_like_numpy(spark):
    got = one_col(spark, [12.25, 12.35, 0.05, 0.15], lambda c: C.round_half_even(c, 1))
    assert got == [12.2, 12.4, 0.0, 0.2]


def test_card_text_formats(spark):
    assert one_col(spark, [12.25, 12.35, 0.05], C.one_decimal) == ["12.2", "12.3", "0.1"]
    assert one_col(spark, [1234567.5], C.thousands) == ["1,234,568"]


def test_guarded_pct_zero_denominator(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a long, b long")
    assert [r[0] for r in df.select(C.guarded_pct("a", "b")).collect()] == [0.0, 25.0]


NBSP = "\u00a0"


@pytest.mark.parametrize("text,default,compat", [
    ("1 234,50 ₽", 1234.5, 1234.5),
    (f"1{NBSP}234,50 ₽", 1234.5, 0.0),
    ("1.234,50", 0.0, 0.0),
    ("", 0.0, 0.0),
    (None, 0.0, 0.0),
    ("1_000", 1000.0, 1000.0),
    ("10f", 0.0, 0.0),
    ("-5", -5.0, -5.0),
    (".5", 0.5, 0.5),
    ("5.", 5.0, 5.0),
    ("1e3", 1000.0, 1000.0),
    ("  42 ", 42.0, 42.0),
    ("1__0", 0.0, 0.0),
])
def test_parse_money(spark, text, default, compat):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(C.parse_money("t").alias("d"), C.parse_money("t", compat=True).alias("c")).first()
    assert row.d == default
    assert row.c == compat


def test_html_text(spark):
    got = one_col(spark, ["<td> A <b>B</b>&amp;</td>", "<p>x &lt;y&gt;</p>"], C.html_text, "string")
    assert got == ["AB&", "x <y>"]


def test_first_field_absent_is_empty(spark):
    df = spark.createDataFrame([('<div class="a b">hi</div>',), ("<div>no</div>",)], "h string")
    got = [r[0] for r in df.select(C.first_field("h", "div", "b")).collect()]
    assert got == ["hi", ""]


def test_nan_read_as_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double").select(
        C.nan_to_null("x").alias("x"))
    from pyspark.sql import functions as F
    row = df.agg(F.sum("x").alias("s"), F.count("x").alias("n"), F.avg("x").alias("m")).first()
    assert (row.s, row.n, row.m) == (1.0, 1, 1.0)


def _python_money(text):
    """The reference's semantics: text stripped, ASCII spaces and the rouble
    sign dropped, comma to point, float(); anything unparsable is 0."""
    t = text.strip().replace(" ", "").replace("₽", "").replace(",", ".")
    try:
        return float(t)
    except ValueError:
        return 0.0


def test_parse_money_compat_equals_python_float_on_random_texts(spark):
    import math
    import random
    rnd = random.Random(17)
    alphabet = list("0123456789") * 4 + list("., _-+eE₽") + [NBSP, "\t", "f", "n", "a", "i", "x"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8))) for _ in range(400)]
    texts += ["nan", "-inf", "Infinity", "1_000.5", "1__0", "_1", "1_", "1e_5", " 12 ", "1 234,5 ₽"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r.i: r.v for r in df.select("i", C.parse_money("t", compat=True).alias("v")).collect()}
    for i, t in enumerate(texts):
        want = _python_money(t)
        if math.isnan(want):
            assert math.isnan(got[i]), t
        else:
            assert got[i] == want, (t, got[i], want)


def _python_text(fragment):
    """get_text(strip=True) on a fragment: text nodes (entities decoded),
    each stripped, empty ones dropped, joined with no separator."""
    from html.parser import HTMLParser

    parts = []

    class P(HTMLParser):
        def handle_data(self, data):
            parts.append(data)

    p = P(convert_charrefs=True)
    p.feed(fragment)
    p.close()
    return "".join(t.strip() for t in parts if t.strip())


def test_html_text_equals_stdlib_parser_on_random_fragments(spark):
    import random
    rnd = random.Random(23)
    tokens = ["<b>", "</b>", "<i>", "</i>", '<span class="x">', "</span>", "<br>", "A", "bc", " ",
              "  ", "\n", "&amp;", "&lt;", "&gt;", "&quot;", "&nbsp;", "1 2", "д", "&amp;lt;"]
    frags = ["".join(rnd.choice(tokens) for _ in range(rnd.randint(0, 10))) for _ in range(300)]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(frags)], "i long, f string")
    got = {r.i: r.v for r in df.select("i", C.html_text("f").alias("v")).collect()}
    for i, f in enumerate(frags):
        assert got[i] == _python_text(f), (f, got[i], _python_text(f))


def test_to_date_lenient(spark):
    import datetime as dt
    df = spark.createDataFrame([("2024-01-05",), ("05.01.2024",), ("junk",), (None,)], "t string")
    got = [r[0] for r in df.select(C.to_date_lenient("t")).collect()]
    assert got == [dt.date(2024, 1, 5), None, None, None]
    got = [r[0] for r in df.select(C.to_date_lenient("t", "dd.MM.yyyy")).collect()]
    assert got == [None, dt.date(2024, 1, 5), None, None]
