"""Personal data by boosted trees over candidate spans, in DataFrame functions.

1. Generators with high recall propose spans, which may overlap: the four base
   kinds and two more (numbers written like telephone numbers without a country
   code, long random-looking words). Regular expressions give the matches and
   the gaps between them; positions are running sums of their lengths.
2. Base spans are the base matches that pass their rule. They always stay.
3. All candidates get features of their format and of the text around them.
   Gradient boosted trees are trained on candidates whose kind has a sure rule
   or a telling context: on half of all of them, by a hash of the candidate. The
   other half sets each kind's threshold: the least score whose candidates are
   right in at least ``PRECISION`` of the cases.
4. Candidates over their kind's threshold become added spans, where they do not
   overlap a base span; of overlapping ones the best scored stays.

The matches of a text are found in linear time: a match can start only where
the run of its characters starts (or right after the last match), and runs are
taken whole.

Defined results: a null text is empty; rows of one id are reported one by one;
without training rows of both classes nothing is added; an empty table gives
an empty one; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import located, table
from tidewater.session import materialize

PRECISION = 0.97
CONTEXT = 24
# Kinds in the order of the contract; the two added ones follow.
BASE = ["email", "ip", "card", "phone"]
ADDED = ["number", "secret"]
LOCAL = "A-Za-z0-9._%+-"
PATTERN = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"(?<![0-9])\(?[2-9][0-9]{2}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9])[A-Za-z0-9]{16,}+",
}
# What a text must hold for a kind to occur at all: spares most texts the search.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def _candidates(rows: DataFrame) -> DataFrame:
    """(doc_id, row_no, kind_no, kind, start, end, span, before, after)."""
    text = F.coalesce("text", F.lit(""))
    kinds = BASE + ADDED
    found = rows.select("doc_id", "row_no", text.alias("text")).select("*", *[
        (F.when(F.contains("text", F.lit(NEEDS[k])), _matches(k)) if k in NEEDS else _matches(k)).alias(f"m_{k}") for k in kinds])
    found = found.filter(" or ".join(f"size(m_{k}) > 0" for k in kinds))

    def spans(k: str) -> Column:
        gaps = F.split("text", PATTERN[k], -1)
        parts = F.transform(gaps, lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(CONTEXT)).alias("tail"), F.left(g, F.lit(CONTEXT)).alias("head")))
        return F.when(F.size(f"m_{k}") > 0, F.struct(F.lit(kinds.index(k)).alias("kind_no"), F.lit(k).alias("kind"),
                                                     F.col(f"m_{k}").alias("spans"), parts.alias("gaps")))

    each = found.select("doc_id", "row_no", F.explode(F.filter(F.array(*[spans(k) for k in kinds]), lambda s: s.isNotNull())).alias("s"))
    each = each.select("doc_id", "row_no", "s.kind_no", "s.kind", F.posexplode(F.transform("s.spans", lambda m, i: F.struct(
        m.alias("span"), F.get(F.col("s.gaps"), i).alias("left"), F.get(F.col("s.gaps"), i + 1).alias("right")))).alias("i", "c"))
    each = each.select("doc_id", "row_no", "kind_no", "kind", "i", "c.span", F.length("c.span").alias("n"), F.col("c.left.n").alias("gap"),
                       F.col("c.left.tail").alias("before"), F.col("c.right.head").alias("after"))
    order = Window.partitionBy("doc_id", "row_no", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("n")).over(order)
    return each.withColumn("end", end).withColumn("start", F.col("end") - F.col("n")).drop("i", "gap", "n")


def _matches(kind: str) -> Column:
    return F.regexp_extract_all("text", F.lit(PATTERN[kind]), F.lit(0))


def _judged(candidates: DataFrame) -> DataFrame:
    """Adds ``valid`` (a base span), ``known`` (the weak label, if there is one)
    and the features."""
    span, before, after = F.col("span"), F.col("before"), F.col("after")
    digits = F.regexp_replace(span, "[^0-9]", "")
    n_digits = F.length(digits)
    kind = F.col("kind")
    luhn = F.when(n_digits.between(14, 19), F.call_function("luhn_check", digits)).otherwise(False)
    octets = span.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    valid = (F.when(kind == "email", F.lit(True)).when(kind == "ip", octets).when(kind == "card", luhn)
             .when(kind == "phone", n_digits.between(10, 15)).otherwise(False))
    named = before.rlike(r"(?i)(pass(word|wd)?|secret|token|api[_-]?key|key)[\"']?\x20{0,2}[:=]\x20{0,2}[\"']?$")
    plain = span.rlike("^(?:[A-Za-z]?[a-z]+|[A-Z]+|[0-9]+)$")
    known = (F.when(kind.isin(BASE), valid)
             .when((kind == "number") & before.rlike(r"\+[0-9]{1,3}[\x20.-]?$"), True)
             .when((kind == "number") & (before.rlike(r"[0-9][\x20.-]?$") | after.rlike("^[\x20.-]?[0-9]")), False)
             .when((kind == "secret") & (named | span.rlike("^(?:AKIA|ASIA)[0-9A-Z]{16}$")), True)
             .when((kind == "secret") & plain, False))
    length = F.length(span)
    features = {
        "f_kind": F.col("kind_no"), "f_length": length, "f_digits": n_digits, "f_digit_share": n_digits / length,
        "f_upper": F.length(F.regexp_replace(span, "[^A-Z]", "")) / length,
        "f_lower": F.length(F.regexp_replace(span, "[^a-z]", "")) / length,
        "f_hex": span.rlike("^[0-9a-f]+$"), "f_changes": F.size(F.regexp_extract_all(span, F.lit("[0-9][A-Za-z]"), F.lit(0))) / length,
        "f_distinct": F.size(F.array_distinct(F.split(span, ""))) / length,
        "f_separators": F.length(F.regexp_replace(span, r"[^\x20().-]", "")), "f_luhn": luhn, "f_octets": octets,
        "f_named": named, "f_assigned": before.rlike("[:=][\x20\"']*$"), "f_quoted": before.rlike("[\"']$"),
        "f_plus": before.rlike(r"\+[0-9]{0,3}[\x20.-]?$"), "f_glued": before.rlike("[A-Za-z0-9]$") | after.rlike("^[A-Za-z0-9]"),
        "f_call": before.rlike(r"(?i)(tel|phone|call|fax|mobil|ruf)[^A-Za-z]{0,4}$"),
    }
    return candidates.select("*", valid.alias("valid"), known.alias("known"), *[f.cast("double").alias(n) for n, f in features.items()])


def _added(judged: DataFrame) -> DataFrame:
    """The candidates over their kind's threshold, with ``score``. Training and
    calibration rows are halves of all candidates with a weak label."""
    names = [c for c in judged.columns if c.startswith("f_")]
    known = judged.filter("known is not null").select("kind", F.col("known").cast("double").alias("label"), *names, F.pmod(
        F.xxhash64("kind", "span", "before", "after"), F.lit(2)).alias("half"))
    known = materialize(known, "pii-known")
    training, calibration = known.filter("half = 0"), known.filter("half = 1")
    if training.select("label").distinct().count() < 2:
        return judged.filter("false").withColumn("score", F.lit(0.0))
    features = VectorAssembler(inputCols=names, outputCol="features")
    model = GBTClassifier(maxIter=8, maxDepth=4, maxBins=32, stepSize=0.3, seed=1).fit(features.transform(training))

    def scored(rows: DataFrame) -> DataFrame:
        return model.transform(features.transform(rows)).withColumn("score", vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability", "prediction")

    # per kind, rows at or above each score (in hundredths) and how many are right
    steps = scored(calibration).groupBy("kind", F.floor(F.col("score") * 100).alias("step")).agg(
        F.count("*").alias("n"), F.sum("label").alias("right"))
    above = Window.partitionBy("kind").orderBy(F.desc("step"))
    least = steps.withColumn("n", F.sum("n").over(above)).withColumn("right", F.sum("right").over(above)).filter(
        F.col("right") >= PRECISION * F.col("n")).groupBy("kind").agg(F.min("step").alias("least"))
    # at most one row a kind
    return scored(judged.filter(~F.col("valid"))).join(F.broadcast(materialize(least, "pii-thresholds")), "kind").filter(
        F.floor(F.col("score") * 100) >= F.col("least")).drop("least")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_no, kind_no, kind, start, end, base) of all chosen spans;
    positions are code points, the end is exclusive."""
    judged = materialize(_judged(_candidates(located(docs, id_col, text_col))), "pii-candidates")
    base = judged.filter("valid").withColumn("score", F.lit(2.0))
    cols = ["doc_id", "row_no", "kind_no", "kind", "start", "end", "score"]
    both = base.select(cols).union(_added(judged).select(cols))
    # islands of overlapping spans; in each, all base spans or else the best one
    order = Window.partitionBy("doc_id", "row_no").orderBy("start", "end", "kind_no")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum((F.col("start") >= F.coalesce("reached", F.lit(0))).cast("int")).over(order)
    marked = both.withColumn("reached", reached).withColumn("island", island)
    best = Window.partitionBy("doc_id", "row_no", "island").orderBy(F.desc("score"), "start", "kind_no")
    chosen = marked.withColumn("nth", F.row_number().over(best)).withColumn("top", F.first("score").over(best))
    return chosen.filter("score = 2 or (top < 2 and nth = 1)").select(*cols[:-1], (F.col("score") == 2).alias("base"))


def _listed(found: Column) -> Column:
    in_order = F.array_sort(found)
    return F.array_join(F.transform(in_order, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the counts of base kinds, base_sha256 and spans."""
    rows = located(docs, id_col, text_col)
    one = F.struct("start", "kind_no", "kind", "end")
    grouped = spans(docs, id_col, text_col).groupBy(F.col("doc_id").alias("_doc"), F.col("row_no").alias("_row")).agg(
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in BASE],
        F.collect_list(F.when(F.col("base"), one)).alias("base"), F.collect_list(one).alias("all"))
    listed = grouped.select("_doc", "_row", *[f"n_{k}" for k in BASE], _listed(F.col("base")).alias("base"), _listed(F.col("all")).alias("spans"))
    joined = rows.select("doc_id", "row_no").join(listed, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row_no") == F.col("_row")), "left")
    return joined.select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): every chosen span replaced by its kind in brackets;
    overlapping base spans become one."""
    order = Window.partitionBy("doc_id", "row_no").orderBy("start", F.desc("end"), "kind_no")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans(docs, id_col, text_col).withColumn("reached", reached).withColumn(
        "run", F.sum((F.col("start") >= F.coalesce("reached", F.lit(0))).cast("int")).over(order))
    runs = runs.groupBy("doc_id", "row_no", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "kind_no")).alias("kind"))
    cuts = runs.groupBy(F.col("doc_id").alias("_doc"), F.col("row_no").alias("_row")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("cuts"))
    rows = located(docs, id_col, text_col)
    joined = rows.join(cuts, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("row_no") == F.col("_row")), "left")
    pieces = F.transform("cuts", lambda c, i: F.concat(
        F.substring("text", F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("cuts"), i - 1)["end"]).cast("int") + 1,
                    (c["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("cuts"), i - 1)["end"])).cast("int")),
        F.lit("["), F.upper(c["kind"]), F.lit("]")))
    last = F.substring("text", F.element_at("cuts", -1)["end"].cast("int") + 1, F.length("text"))
    return joined.select("doc_id", F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.concat(F.array_join(pieces, ""), last)).alias("text"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def brute_force(docs: list[tuple]) -> dict:
    """Base spans with Python's regular expressions (for tests)."""
    import hashlib
    import re

    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def ok(kind, s):
        d = [int(c) for c in s if c in "0123456789"]
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            return 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d[::-1])) % 10 == 0
        return kind == "email" or 10 <= len(d) <= 15

    out = {}
    for doc_id, text in docs:
        found = [(m.start(), i, k, m.end()) for i, k in enumerate(BASE) for m in re.finditer(plain[k], text or "") if ok(k, m[0])]
        listed = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))
        out[doc_id] = (*(sum(f[2] == k for f in found) for k in BASE), hashlib.sha256(listed.encode()).hexdigest())
    return out
