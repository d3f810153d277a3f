"""WARC archives and their globally ordered capture index.

Writing: each page is one WARC/1.1 record. Of equal payloads of at least 1000
bytes the page with the largest id is a response, the others are revisit
records that refer to it; they keep the HTTP header, not the payload. Records
are UTF-8 text that ends in two line breaks, so Spark's text writer with that
line separator writes plain WARC files on any file system, with its commit
protocol; a lost task is simply written again.

Reading: an archive of bounded size is read as a whole and cut by the records'
own lengths (payloads may hold anything). Every payload's SHA-1 is computed
again and compared.

Index: each archive gives a run of captures sorted by (URL key, time, page).
External merge: the runs are cut into key ranges, and each range merges its
slices of all runs with a loser tree. Ranges are cut on the whole key, so one
very frequent host or URL spans many ranges. Partitions are in key order: the
result is one ordered capture history per URL, globally ordered.

Defined results: null html is an empty payload; a null URL gives a record
without target, first in order; line breaks in a URL are percent-coded; rows
of one page id are records of their own, and if they hold the largest id of
equal payloads all of them are responses; a null id is smaller than any; an
empty table gives no archive and an empty index; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import table, tasks_for
from tidewater.session import materialize, scratch_path

LEAST_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 16 << 20
RANGE_CAPTURES = 100_000
BREAK = "\r\n"
# Pages carry no capture time: without a time column, page n counts as
# captured n seconds after this moment.
FIRST_CAPTURE = 1_704_067_200

CAPTURE = ("url_key string, captured string, page string, url string, record_type string, refers string, "
           "payload_bytes long, payload_digest string, archive string, offset long, length long")
NAMES = [part.split()[0] for part in CAPTURE.split(", ")]


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            time_col: str | None = None) -> tuple[DataFrame, int]:
    """The record texts of ``pages``, and how many of them fit an archive."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    when = F.timestamp_seconds(F.coalesce(F.col(id_col).cast("long"), F.lit(0)) + FIRST_CAPTURE) if time_col is None else F.col(time_col)
    rows = pages.select(
        F.col(id_col).alias("page"), F.col(url_col).alias("url"), payload.alias("payload"),
        F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
        F.octet_length(payload).cast("long").alias("size"), F.sha1(payload.cast("binary")).alias("digest"))
    sizes = rows.agg(F.count("*"), F.sum("size")).first()
    repeated = rows.filter(F.col("size") >= LEAST_REVISIT_BYTES).groupBy("digest").agg(
        F.max("page").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # written once, so that the join is planned by its real size: a short list
    # is broadcast and the payloads are not shuffled
    rows = rows.join(materialize(repeated, "warc-repeated"), "digest", "left")
    revisit = (F.col("first").isNotNull() & (F.col("size") >= LEAST_REVISIT_BYTES)
               & (F.col("page").isNull() | (F.col("page") < F.col("first"))))
    page = F.coalesce(F.col("page").cast("string"), F.lit("null"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
                    F.col("size").cast("string"), F.lit(BREAK * 2))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat(
        F.lit(f"WARC/1.1{BREAK}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{BREAK}WARC-Record-ID: <urn:page:"), page, F.lit(f">{BREAK}WARC-Date: "), F.col("time"),
        F.coalesce(F.concat(F.lit(f"{BREAK}WARC-Target-URI: "), url), F.lit("")),
        F.when(revisit, F.concat(
            F.lit(f"{BREAK}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                  f"{BREAK}WARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))).otherwise(F.lit("")),
        F.lit(f"{BREAK}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit(f"{BREAK}Content-Type: application/http; msgtype=response{BREAK}Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(BREAK * 2))
    average = (sizes[1] or 0) / max(1, sizes[0]) + 600
    return rows.select(F.concat(header, block).alias("value")), max(1, int(ARCHIVE_BYTES / average))


def write_archives(pages: DataFrame, path: str, **columns) -> str:
    """Write the archives under ``path``, each of about ARCHIVE_BYTES."""
    found, per_file = records(pages, **columns)
    found.write.option("lineSep", BREAK * 2).option("maxRecordsPerFile", per_file).text(path)
    return path


def url_key(url: str | None) -> str:
    """Sort-friendly form: host parts reversed, then path and query; no
    scheme, www, default port or fragment. Not a URL: the text itself."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url
    if not host:
        return url
    port = f":{port}" if port and port != {"http": 80, "https": 443}.get(parts.scheme.lower()) else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def parse_archive(name: str, data: bytes) -> Iterator[tuple]:
    """The captures of an archive, in file order."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].decode().split(BREAK)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"{name}: no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        end = head + 4 + int(fields["Content-Length"])
        block = data[head + 4:end]
        if data[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"{name}: the record at byte {at} does not end at byte {end}")
        http = block.index(b"\r\n\r\n") + 4
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "revisit":
            size = next(int(x.split(b": ")[1]) for x in block[:http].split(b"\r\n") if x.startswith(b"Content-Length"))
        else:
            size = len(block) - http
            if hashlib.sha1(block[http:]).hexdigest() != digest:
                raise ValueError(f"{name}: the payload at byte {at} does not match its digest")
        page = fields["WARC-Record-ID"][len("<urn:page:"):-1]
        refers = fields["WARC-Refers-To"][len("<urn:page:"):-1] if "WARC-Refers-To" in fields else None
        url = fields.get("WARC-Target-URI")
        yield (url_key(url), fields["WARC-Date"], None if page == "null" else page, url, fields["WARC-Type"], refers,
               size, digest, name, at, end + 4 - at)
        at = end + 4


def _order(capture: tuple) -> tuple:
    return capture[0], capture[1], capture[2] is not None, len(capture[2] or ""), capture[2] or "", capture[8], capture[9]


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """One sorted run per archive, with ``seq`` as the place in the run."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch["path"], batch["content"]):
                found = sorted(parse_archive(name, bytes(data)), key=_order)
                yield pd.DataFrame(found, columns=NAMES).assign(seq=range(len(found)))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInPandas(run, CAPTURE + ", seq long")


class LoserTree:
    """Merges k sorted runs. Inner nodes hold the loser of their match, the
    root's parent the winner; replacing the winner replays one path."""

    def __init__(self, runs: list[Iterator[tuple]], key):
        self.runs, self.key = runs, key
        self.heads: list[tuple | None] = [None] * len(runs)
        self.keys: list = [None] * len(runs)
        for i in range(len(runs)):
            self._advance(i)
        self.loser = [-1] * max(1, len(runs))
        for i in range(len(runs)):
            self._replay(i, building=True)

    def _advance(self, i: int) -> None:
        self.heads[i] = next(self.runs[i], None)
        self.keys[i] = None if self.heads[i] is None else self.key(self.heads[i])

    def _beats(self, a: int, b: int) -> bool:
        if self.keys[b] is None or self.keys[a] is None:
            return self.keys[a] is not None or self.keys[b] is None and a < b
        return (self.keys[a], a) < (self.keys[b], b)

    def _replay(self, i: int, building: bool = False) -> None:
        winner, node = i, (i + len(self.runs)) // 2
        while node > 0:
            other = self.loser[node]
            if other < 0 and building:
                self.loser[node] = winner
                return
            if self._beats(other, winner):
                self.loser[node], winner = winner, other
            node //= 2
        self.loser[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.heads[self.loser[0]] is not None:
            i = self.loser[0]
            yield self.heads[i]
            self._advance(i)
            self._replay(i)


def merged_index(runs: DataFrame) -> DataFrame:
    """The runs' captures in global order of (URL key, time, page)."""
    spark = runs.sparkSession
    total = runs.count()
    ranges = runs.repartitionByRange(tasks_for(spark, total, RANGE_CAPTURES), "url_key", "captured",
                                     F.length("page").asc_nulls_first(), F.col("page").asc_nulls_first(), "archive", "offset")

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slices: dict[str, list[tuple]] = {}
        for batch in batches:
            batch = batch.astype(object).where(batch.notna(), None)
            for capture in batch[NAMES].itertuples(index=False, name=None):
                slices.setdefault(capture[8], []).append(capture)
        out: list[tuple] = []
        for capture in LoserTree([iter(s) for _, s in sorted(slices.items())], _order):
            out.append(capture)
            if len(out) == 10_000:
                yield pd.DataFrame(out, columns=NAMES)
                out = []
        if out:
            yield pd.DataFrame(out, columns=NAMES)

    return ranges.sortWithinPartitions("archive", "seq").mapInPandas(merge, CAPTURE)


def capture_index(spark: SparkSession, path: str) -> DataFrame:
    return merged_index(materialize(capture_runs(spark, path), "warc-runs"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = write_archives(pages, scratch_path(spark, "warc"))
    return capture_index(spark, path).select(
        F.col("page").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers").cast("long").alias("refers_to"))


OP2_SQL = """
with p as (select page_id, strlen(coalesce(html, '')) payload_bytes, sha1(coalesce(html, '')) payload_digest from pages),
     g as (select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest) end first from p)
select page_id, payload_bytes, payload_digest,
       case when page_id < first then 'revisit' else 'response' end record_type,
       case when page_id < first then first end refers_to
from g
"""
