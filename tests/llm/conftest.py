import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"w{i * 7919 % 100003}" for i in range(30_000))
BASE = " ".join(f"base{i}" for i in range(120))


def near(words, *changed):
    out = words.split()
    for i in changed:
        out[i] = f"x{i}"
    return " ".join(out)


EDGES = [
    (9001, None), (9002, ""), (9003, " \t\n\x0b\x0c\r "), (9004, "One"), (9005, "one two THREE four"), (9006, "ONE two three four"),
    (9010, BASE), (9011, BASE), (9012, "  " + BASE.replace(" ", " \n")), (9013, near(BASE, 60)), (9014, near(BASE, 10, 100)),
    (9015, near(BASE, *range(0, 120, 7))), (9020, LONG), (9021, "é ß 😀 “q”  x y " * 30),
    (9030, "Ärger\x00null\x01 control <|endoftext|> a  b"), (9031, "a " * 400), (9032, "aaaa" * 200),
]


@pytest.fixture(scope="session")
def rows(spark, sf_dir):
    """Ids are unique and not null; texts are of every odd kind."""
    some = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(50).select("doc_id", "text").collect()
    return [tuple(r) for r in some] + EDGES


# Names that operators use inside; a table may have columns called so.
CLASHING = ["score", "held_out", "predicted", "n_words", "n_hit", "hit_items", "clean_text", "set_id", "tokens", "token", "digest",
            "keep_id", "text_sha256", "row_no", "start", "kept", "_id", "_doc", "own", "doc", "id", "grp", "n", "a", "b", "kind"]


@pytest.fixture(scope="session")
def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.select("doc_id", "text", *[F.lit(None).cast("string").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids, repeated rows and ids with several texts."""
    found = [(None, BASE), (None, None), (1, BASE), (1, BASE), (2, near(BASE, 60)), (2, "another text"), (3, None), (3, None)]
    return spark.createDataFrame(found, "doc_id long, text string")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")
