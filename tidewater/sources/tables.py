"""Table maintenance: schemas, append log, latest-per-key view, CSV source.

The reference's ``INSERT OR REPLACE`` into tables keyed only by an
autoincrement id appends on every refresh. Here that is an append log of
batch directories (``batch_id=N``, overwritten as a whole, so a replayed
batch is idempotent) plus a manifest written last; readers semi-join the
manifest, so a half-written batch is never read. The upsert the verb
intends is a view: the newest row per natural key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# -- K1: schemas (declared types mapped to Spark types) --------------------------------------

S, L, D, B, DT, TS = (T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(),
                      T.DateType(), T.TimestampType())


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SCHEMAS: dict[str, T.StructType] = {
    "implementations": _schema(
        ("impl_id", L), ("org_name", S), ("solution_name", S), ("vendor_name", S), ("class_scm", S),
        ("region_name", S), ("industry_name", S), ("date_go_live", DT), ("status", S),
        ("is_domestic", B), ("capex", L), ("revenue_uplift", L), ("opex_delta", L),
        ("inv_turnover_delta", D), ("lead_time_delta", D), ("penalties_delta", L)),
    "kpi_monthly": _schema(
        ("date_month", DT), ("year", L), ("quarter", L), ("impl_count", L),
        ("domestic_impl_count", L), ("domestic_share_pct", D), ("total_econ_effect", L),
        ("avg_econ_effect", D), ("support_count", L), ("total_support_amount", L),
        ("support_coverage_pct", D), ("isi_index", D)),
    "support_measures": _schema(
        ("support_id", L), ("program_name", S), ("measure_type", S), ("recipient_name", S),
        ("amount_rub", L), ("approval_date", DT), ("disbursement_date", DT), ("roi_pct", D),
        ("cost_per_impl", L)),
    "real_solutions": _schema(
        ("id", L), ("name", S), ("vendor", S), ("version", S), ("registration_date", S),
        ("status", S), ("category", S), ("is_domestic", B), ("source", S), ("created_at", TS)),
    "real_procurements": _schema(
        ("id", L), ("title", S), ("url", S), ("customer", S), ("price", D),
        ("publication_date", S), ("keyword", S), ("source", S), ("created_at", TS)),
    "real_indicators": _schema(
        ("id", L), ("indicator", S), ("year", L), ("value", D), ("unit", S), ("region", S),
        ("source", S), ("created_at", TS)),
    "real_support_measures": _schema(
        ("id", L), ("title", S), ("description", S), ("amount", D), ("deadline", S),
        ("requirements", S), ("source", S), ("created_at", TS)),
}

# Natural keys of the latest-per-key views (K3).
NATURAL_KEYS = {
    "real_solutions": ["name", "vendor", "version"],
    "real_procurements": ["url", "keyword"],
    "real_indicators": ["indicator", "year", "region"],
    "real_support_measures": ["title"],
}


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


# -- K2: surrogate ids and the append log ------------------------------------------------------

def with_dense_ids(df: DataFrame, start: int = 1, id_col: str = "id") -> DataFrame:
    """Consecutive ids from ``start`` without moving rows to one task.

    Per-partition row counts (one small row per partition) give each
    partition its offset; a row's id is offset + its position in the
    partition. The tagged rows are checkpointed to the shared folder, so the
    input is computed once and the ids are stable even if it is not
    deterministic or an executor is lost.
    """
    from tidewater.session import materialize

    tagged = materialize(df.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_mid", F.monotonically_increasing_id()), "dense-ids")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    # ``counts`` has one row per input partition: its size is bounded by the
    # partition count, which is what makes the broadcast and window safe.
    from pyspark.sql.window import Window
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = tagged.join(F.broadcast(offsets.select("_pid", "_off", "_m0")), "_pid")
    return out.withColumn(id_col, F.lit(start) + F.col("_off") + F.col("_mid") - F.col("_m0")).drop(
        "_pid", "_mid", "_off", "_m0")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the declared columns and types: absent ones are
    null, undeclared ones are left out."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def write_batch(df: DataFrame, log_path: str, batch_id: int, schema: T.StructType | None = None) -> None:
    """Write one refresh as ``batch_id=N`` (overwrite: a replay is idempotent),
    in the declared columns if there is a schema, stamped with ``created_at``;
    not visible until published."""
    if schema is not None:
        df = conform(df, schema)
    (df.withColumn("created_at", F.current_timestamp())
       .withColumn("batch_id", F.lit(batch_id).cast("long"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id").parquet(f"{log_path}/data"))


# What a commit keeps about each table's batch. The summaries of batches merge:
# counts add up, bounds widen, the sketches of distinct keys unite.
SUMMARY = T.StructType([
    T.StructField("name", S), T.StructField("n_rows", L), T.StructField("last_id", L), T.StructField("null_keys", L),
    T.StructField("first_created", TS), T.StructField("last_created", TS), T.StructField("keys", T.BinaryType())])
MANIFEST = T.StructType([T.StructField("batch_id", L), T.StructField("committed_at", TS),
                         T.StructField("tables", T.ArrayType(SUMMARY))])


def publish(spark: SparkSession, manifest_path: str, batch_id: int, tables: list | None = None) -> None:
    """Commit: one manifest row, written after all data of the batch, with the
    summary of each table's batch."""
    row = spark.createDataFrame([(batch_id, None, tables or [])], MANIFEST)
    row.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(manifest_path)


def batch_summary(spark: SparkSession, name: str, log_path: str, batch_id: int):
    """The summary of a written batch (one pass over its few columns). Keys are
    the table's natural key; a table without one counts none."""
    batch = spark.read.parquet(f"{log_path}/data/batch_id={batch_id}")
    keys = [k for k in NATURAL_KEYS.get(name, []) if k in batch.columns]
    lacks = F.lit(False)
    for k in keys:
        lacks = lacks | F.col(k).isNull()
    key = F.when(~lacks, F.xxhash64(*keys)) if keys else F.lit(None).cast("long")
    return batch.agg(
        F.lit(name).alias("name"), F.count("*").alias("n_rows"),
        (F.max("id") if "id" in batch.columns else F.lit(None)).cast("long").alias("last_id"),
        F.count_if(lacks).alias("null_keys"), F.min("created_at").alias("first_created"), F.max("created_at").alias("last_created"),
        F.hll_sketch_agg(key, F.lit(14)).alias("keys")).first()


def source_state(spark: SparkSession, manifest_path: str) -> DataFrame:
    """What is known of each table from the commits alone, without reading any
    data: n_rows, last_id, null_keys, first_created, last_created, and
    n_keys, an estimate of its distinct natural keys. A replayed batch counts as
    last committed."""
    commits = spark.read.schema(MANIFEST).parquet(manifest_path)
    each = commits.select("batch_id", "committed_at", F.explode("tables").alias("t")).groupBy("batch_id", "t.name").agg(
        F.max_by("t", "committed_at").alias("t"))
    return each.groupBy("name").agg(
        F.sum("t.n_rows").alias("n_rows"), F.max("t.last_id").alias("last_id"), F.sum("t.null_keys").alias("null_keys"),
        F.min("t.first_created").alias("first_created"), F.max("t.last_created").alias("last_created"),
        F.hll_sketch_estimate(F.hll_union_agg("t.keys")).alias("n_keys"))


def append_batch(df: DataFrame, log_path: str, batch_id: int) -> None:
    """Write one batch of one log and publish it in that log's manifest."""
    write_batch(df, log_path, batch_id)
    publish(df.sparkSession, f"{log_path}/_manifest", batch_id)


def read_log(spark: SparkSession, log_path: str, manifest_path: str | None = None,
             schema: T.StructType | None = None) -> DataFrame:
    """Committed rows only: the data semi-joined with the manifest (the log's
    own, or a shared one when several logs commit together). With the declared
    schema a log whose batches were all empty reads as no rows."""
    reader = spark.read
    if schema is not None:
        stamped = [T.StructField("created_at", TS), T.StructField("batch_id", L)]
        names = {f.name for f in stamped}
        reader = reader.schema(T.StructType([f for f in schema if f.name not in names] + stamped))
    data = reader.parquet(f"{log_path}/data")
    manifest = spark.read.parquet(manifest_path or f"{log_path}/_manifest").select(
        "batch_id").distinct()
    return data.join(manifest, "batch_id", "left_semi")


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def save_all(spark: SparkSession, datasets: dict[str, DataFrame], root: str, batch_id: int) -> None:
    """Store one refresh of several sources with a single commit (K2 + K7).

    Each dataset gets dense surrogate ids continuing after the largest
    committed id of its log (kept in the manifest, so no log is read), and is written as ``root/<name>/data/batch_id=N``.
    Only after every dataset is written does one manifest row at
    ``root/_manifest`` publish the batch for all of them; a failure before
    that leaves the batch invisible to readers. Tables of ``SCHEMAS`` are
    written in their declared columns.
    """
    manifest = f"{root}/_manifest"
    last = {}
    if _path_exists(spark, manifest):
        earlier = spark.read.schema(MANIFEST).parquet(manifest).filter(F.col("batch_id") != batch_id)
        last = dict(earlier.select(F.explode("tables").alias("t")).groupBy("t.name").agg(F.max("t.last_id")).collect())
    tables = []
    for name, df in datasets.items():
        log = f"{root}/{name}"
        write_batch(with_dense_ids(df.drop("id"), (last.get(name) or 0) + 1), log, batch_id, SCHEMAS.get(name))
        written = _path_exists(spark, f"{log}/data/batch_id={batch_id}")  # an empty batch leaves no folder
        tables.append(batch_summary(spark, name, log, batch_id) if written else (name, 0, None, 0, None, None, None))
    publish(spark, manifest, batch_id, tables)


def latest_per_key(log: DataFrame, keys: list[str], order_cols=("created_at", "batch_id", "id")) -> DataFrame:
    """The newest row per natural key (upsert semantics as a view); rows of one
    batch are ordered by their id, the last one wins.

    An aggregate (``max_by`` over a struct ordering) rather than a window, so
    a key repeated in many batches is combined map-side before the shuffle.
    """
    payload = [c for c in log.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_cols if c in log.columns])
    agg = log.groupBy(*keys).agg(F.max_by(F.struct(*payload), order).alias("_row"))
    return agg.select(*keys, *[F.col("_row")[c].alias(c) for c in payload])


def _snapshots(spark: SparkSession, log_path: str):
    """The newest snapshot as (upto, n_rows, path), or None."""
    where = f"{log_path}/_snapshots"
    if not _path_exists(spark, where):
        return None
    return spark.read.schema("upto long, n_rows long, path string").parquet(where).orderBy(F.col("upto").desc()).first()


def read_latest(spark: SparkSession, log_path: str, keys: list[str], manifest_path: str | None = None,
                schema: T.StructType | None = None) -> DataFrame:
    """The newest committed row per natural key (``latest_per_key`` of the whole
    log) from the newest snapshot and the batches after it; the folders of
    earlier batches are not read."""
    log = read_log(spark, log_path, manifest_path, schema)
    newest = _snapshots(spark, log_path)
    if newest is None:
        return latest_per_key(log, keys)
    kept = spark.read.schema(log.schema).parquet(newest.path)
    return latest_per_key(kept.unionByName(log.filter(F.col("batch_id") > newest.upto)), keys)


def compact(spark: SparkSession, log_path: str, keys: list[str], manifest_path: str | None = None,
            schema: T.StructType | None = None, ratio: float = 0.5) -> bool:
    """Write a new snapshot when the batches after the last one hold at least
    ``ratio`` times its rows. So every appended row is rewritten a bounded number
    of times on average, and a refresh costs what its batch does, not what the log
    does. The snapshot becomes visible by one row in ``_snapshots``, written
    last; batches up to it must not be replayed with other rows. Returns whether
    it wrote one."""
    import uuid

    newest = _snapshots(spark, log_path)
    log = read_log(spark, log_path, manifest_path, schema)
    fresh = log.filter(F.col("batch_id") > newest.upto) if newest else log
    state = fresh.agg(F.count("*").alias("n"), F.max("batch_id").alias("upto")).first()
    if not state.n or (newest and state.n < ratio * newest.n_rows):
        return False
    path = f"{log_path}/snapshot/upto={state.upto}-{uuid.uuid4().hex[:8]}"
    current = read_latest(spark, log_path, keys, manifest_path, schema)
    current.filter(F.col("batch_id") <= state.upto).select(log.columns).write.parquet(path)
    n_rows = spark.read.parquet(path).count()
    spark.createDataFrame([(state.upto, n_rows, path)], "upto long, n_rows long, path string").coalesce(1).write.mode(
        "append").parquet(f"{log_path}/_snapshots")
    return True


def write_if_empty(df: DataFrame, path: str) -> None:
    """K5: load only while the target holds no rows (or does not exist)."""
    spark = df.sparkSession
    if not _path_exists(spark, path):
        df.write.parquet(path)
    elif not spark.read.schema(df.schema).parquet(path).limit(1).count():
        df.write.mode("append").parquet(path)


def create_tables(spark: SparkSession, root: str) -> list[str]:
    """K1: every table of ``SCHEMAS`` as an empty parquet table under
    ``root``, created only where absent (existing data is left alone)."""
    for name, schema in SCHEMAS.items():
        if not _path_exists(spark, f"{root}/{name}"):
            empty(spark, schema).write.parquet(f"{root}/{name}")
    return [f"{root}/{name}" for name in SCHEMAS]


# -- S11: collect all sources ------------------------------------------------------------------

class SourcesFailed(RuntimeError):
    """Sources that could not be collected; ``errors`` has each one's exception."""

    def __init__(self, errors: dict[str, Exception]):
        self.errors = errors
        super().__init__("; ".join(f"{name}: {type(e).__name__}: {str(e).strip().partition(chr(10))[0]}" for name, e in errors.items()))


def collect_sources(spark: SparkSession,
                    loaders: dict[str, tuple[Callable[[], DataFrame], T.StructType]],
                    every: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """Build each named dataset; one that fails, while it is planned or while
    it runs, becomes an empty frame of its schema and the others go on. Each is
    written once to the shared folder, so what is counted here is what is
    stored later. Returns the datasets and one status row per source:
    (source, n_rows, status).

    Only the status tells a failed source from one without rows. Who does not
    read it asks for ``every`` source: then ``SourcesFailed`` is raised after
    all were tried, if any failed."""
    from tidewater.session import materialize

    out, status, errors = {}, [], {}
    for name, (load, schema) in loaders.items():
        try:
            out[name] = materialize(load(), f"source-{name}")
            status.append((name, out[name].count(), "ok"))
        except Exception as e:  # a broken source must not stop the others
            errors[name] = e
            out[name] = empty(spark, schema)
            status.append((name, 0, f"error: {type(e).__name__}"))
    if every and errors:
        raise SourcesFailed(errors) from next(iter(errors.values()))
    return out, spark.createDataFrame(status, "source string, n_rows long, status string")


# -- S13: CSV source ---------------------------------------------------------------------------

def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Procurement dumps as CSV: explicit schema (never inferred), malformed
    lines kept with their raw text in ``_corrupt_record``."""
    full = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType(), True)])
    return (spark.read.schema(full)
            .option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .csv(path))
