"""Lake zones: landing raw files, reading them back, the newest snapshot,
processed zones (S1-S5, S9, S12-S13).

Layout under a lake root (shared storage on a cluster)::

    raw/<source>/<data_type>/ingest_date=YYYY-MM-DD/ingest_ts=YYYYMMDD_HHMMSSffffff/part-*
    processed/<zone>/version=<stamp>/part-*.parquet
    speed/clicks/stream=<query id>/arrival_batch=<n>/   (see streaming.speed_layer)
"""

from __future__ import annotations

import csv
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from featurelake.schemas import TX_COLUMNS, TX_RAW
from featurelake.sources import files


# -- Hadoop file-system helpers (driver-side metadata calls only) ------------

def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (a directory listing, no data read)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


# -- S1 / S3: readers -------------------------------------------------------

# CSV dialect of the feeds (quotes doubled inside quoted fields).
CSV_DIALECT = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "enforceSchema": "false",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _first_line(spark: SparkSession, path: str) -> str:
    fs, p = _fs_path(spark, path)
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def _by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files of each header line.  The tasks read the lines; only paths reach
    the driver, grouped (Spark plans scans from them).  The driver opens files
    itself only where tasks cannot, on file systems only Spark can read."""
    names = spark.read.format("csv").option("header", "true").load(path).inputFiles()
    if not names:
        return {}
    if files.readable(names[0]):
        found = files.headers(spark.read.format("binaryFile").load(path).select("path", "length"))
        return {r["header"]: sorted(r["paths"]) for r in found.collect()}
    groups: dict[str, list[str]] = {}
    for f in names:
        groups.setdefault(_first_line(spark, f).lstrip("\ufeff"), []).append(f)
    return groups


def read_csv_by_header(spark: SparkSession, path: str) -> DataFrame:
    """All columns of CSV files as text, found by header *name*.

    Files whose headers differ are read in groups and united by name; a column
    that a group lacks is null there.  One pass over the files' first lines,
    in tasks, finds the groups: a scan a header, not a file.
    """
    groups = _by_header(spark, path)
    out = None
    for header in sorted(h for h in groups if h.strip()):
        names = next(csv.reader([header]))
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        part = spark.read.options(**CSV_DIALECT).schema(schema).csv(groups[header])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out if out is not None else spark.createDataFrame([], TX_RAW)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Transactions CSV with header.  Cells stay text; columns come by
    name, the declared ones first; extra ones are kept and missing ones are
    left out (a schema failure, V4)."""
    df = read_csv_by_header(spark, path)
    return df.select(*[c for c in TX_COLUMNS if c in df.columns], *[c for c in df.columns if c not in TX_COLUMNS])


def read_products(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """S3: product metadata JSON (schema unknown: inferred on read), a JSON
    object a line.  ``multi_line`` is for whole-document files (one array or
    object per file), each of which is read by one task."""
    return spark.read.option("multiLine", multi_line).json(path)


# -- S2: landing ------------------------------------------------------------

def _stamp(ingest_ts: _dt.datetime | None) -> tuple[str, str]:
    ts = ingest_ts or _dt.datetime.now(_dt.timezone.utc)
    return ts.strftime("%Y-%m-%d"), ts.strftime("%Y%m%d_%H%M%S%f")


def raw_path(lake: str, source: str, data_type: str) -> str:
    return f"{lake.rstrip('/')}/raw/{source}/{data_type}"


def land_raw(df: DataFrame, lake: str, source: str, data_type: str,
             ingest_ts: _dt.datetime | None = None, fmt: str = "csv") -> str:
    """Write one new raw snapshot (never overwrites an earlier one).  The
    rows of ``read_transactions`` land cell by cell as they came.

    The snapshot is its own partition folder ``ingest_date=…/ingest_ts=…``;
    returns the snapshot's ingest_ts value.
    """
    date_part, ts_part = _stamp(ingest_ts)
    target = f"{raw_path(lake, source, data_type)}/ingest_date={date_part}/ingest_ts={ts_part}"
    w = df.write.mode("errorifexists")
    if fmt == "csv":
        w.options(header="true", quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(target)
    elif fmt == "json":
        w.option("ignoreNullFields", "false").json(target)
    else:
        w.format(fmt).save(target)
    return ts_part


# -- S4 / S5: choosing what to read ----------------------------------------

def latest_snapshot_path(spark: SparkSession, lake: str, source: str, data_type: str) -> str | None:
    """Folder of the newest *committed* snapshot, from listings only: newest
    date first, and in it the newest folder that holds ``_SUCCESS``."""
    base = raw_path(lake, source, data_type)
    for d in sorted((d for d in list_dirs(spark, base) if d.startswith("ingest_date=")), reverse=True):
        for t in sorted((t for t in list_dirs(spark, f"{base}/{d}") if t.startswith("ingest_ts=")), reverse=True):
            if path_exists(spark, f"{base}/{d}/{t}/_SUCCESS"):
                return f"{base}/{d}/{t}"
    return None


def latest_snapshot(spark: SparkSession, lake: str, source: str = "internal",
                    data_type: str = "transactions", reader=None) -> DataFrame | None:
    """Only the newest committed raw snapshot; its folder alone is read."""
    path = latest_snapshot_path(spark, lake, source, data_type)
    if path is None:
        return None
    return reader(path) if reader else read_transactions(spark, path)


def new_version() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")


def newest_version(spark: SparkSession, base: str) -> str | None:
    """The newest committed ``version=`` folder under ``base``."""
    for v in sorted((d for d in list_dirs(spark, base) if d.startswith("version=")), reverse=True):
        if path_exists(spark, f"{base}/{v}/_SUCCESS"):
            return f"{base}/{v}"
    return None


def write_version(df: DataFrame, base: str) -> str:
    """``df`` as a new version under ``base``; the former one stays in place
    and is what readers see until this one is committed."""
    path = f"{base.rstrip('/')}/version={new_version()}"
    df.write.mode("errorifexists").parquet(path)
    return path


def read_version(spark: SparkSession, base: str) -> DataFrame:
    path = newest_version(spark, base.rstrip("/"))
    if path is None:
        raise FileNotFoundError(f"no committed version under {base}")
    return spark.read.parquet(path)


def zone_path(lake: str, zone: str) -> str:
    return f"{lake.rstrip('/')}/processed/{zone}"


def write_zone(df: DataFrame, lake: str, zone: str) -> str:
    """Replace a processed zone (Parquet).  Each write is a new
    version; readers see it once it is committed, and the one before until then."""
    return write_version(df, zone_path(lake, zone))


def read_zone(spark: SparkSession, lake: str, zone: str) -> DataFrame:
    path = newest_version(spark, zone_path(lake, zone))
    if path is None:
        raise FileNotFoundError(f"no committed version of zone {zone} under {lake}")
    return spark.read.parquet(path)


def resolve_interactions(spark: SparkSession, lake: str) -> DataFrame | None:
    """Combined (batch + stream) zone if there is one, else the newest
    batch snapshot.  A combined zone without a committed version is an error:
    the batch alone would silently lose the stream's rows."""
    if path_exists(spark, zone_path(lake, "combined")):
        return read_zone(spark, lake, "combined")
    return latest_snapshot(spark, lake)


# -- S9: the speed table as a batch snapshot --------------------------------

def committed_batches(spark: SparkSession, path: str) -> list[str]:
    """Folders of the micro-batches that were written completely."""
    return [f"{path}/{s}/{b}" for s in list_dirs(spark, path) if s.startswith("stream=")
            for b in list_dirs(spark, f"{path}/{s}") if path_exists(spark, f"{path}/{s}/{b}/_SUCCESS")]


def read_speed(spark: SparkSession, speed_path: str) -> DataFrame:
    """Rows of the committed micro-batches, compacted or not.  A batch
    that is being written or has failed is not part of the snapshot."""
    from featurelake.streaming import compaction

    rows = compaction.snapshot(spark, speed_path)
    if rows is None:
        raise FileNotFoundError(f"no committed micro-batch under {speed_path}")
    return rows


def read_arrivals(spark: SparkSession, speed_path: str) -> DataFrame:
    """The same rows with ``arrival_number``, 1 to n without gaps."""
    from featurelake.streaming import compaction

    rows = compaction.snapshot(spark, speed_path, numbered=True)
    if rows is None:
        raise FileNotFoundError(f"no committed micro-batch under {speed_path}")
    return rows
