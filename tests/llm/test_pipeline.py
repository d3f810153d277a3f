import os
import subprocess
import sys

import corpus_pipeline as C
from tidewater.llm import registry
from tidewater.llm.common import xxhash64

import numpy as np


def test_stages_chain_and_keep_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert [n for n, _ in C.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard", "decontamination", "packing"]
    packed = C.run(spark, sf_dir)
    assert {"doc_id", "start", "length", "sequence_id", "ids"} <= set(packed.columns)
    n = packed.select("doc_id").distinct().count()
    assert 0.5 * before < n < before
    assert columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_is_registered():
    assert {q.split("_")[0] for q in registry.QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_xxhash64_is_sparks(spark):
    ids = [0, 1, -1, 42, 1 << 40, -(1 << 62)]
    rows = spark.createDataFrame([(i, 7 * i % 1000) for i in ids], "a long, b long").selectExpr("xxhash64(a) one", "xxhash64(a, b) two").collect()
    one = xxhash64(np.array(ids))
    two = xxhash64(np.array([7 * i % 1000 for i in ids]), one)
    assert [r.one for r in rows] == one.view(np.int64).tolist() and [r.two for r in rows] == two.view(np.int64).tolist()


def test_without_the_folders_the_rest_imports(tmp_path):
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in ("__spark_entry__.py", "tidewater"):
        if name.endswith(".py"):
            (tmp_path / name).write_text(open(f"{here}/{name}").read())
    package = tmp_path / "tidewater"
    package.mkdir()
    for name in os.listdir(f"{here}/tidewater"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{here}/tidewater/{name}", package / name)
    code = "import __spark_entry__ as e; print(sum(q.startswith('op') and q[2].isdigit() for q in e.queries()), len(e.oracle_sql()) > 50)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)},
                         capture_output=True, text=True, check=True).stdout
    assert out.split() == ["0", "True"]
