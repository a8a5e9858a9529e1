"""Incremental load of landed files into the raw tables, oldest date folder first.

A small table of finished files is the load state: a file is pending while that table does not have
it. Pending files load in batches of a bounded number, in the order of their date folder and name.
What a batch consists of is written down before it is read, and a batch overwrites its own
partitions, so one that is replayed after a crash neither loses nor doubles rows. Rows and bad lines
are observed while they are written; nothing of an earlier batch is read.

    <warehouse>/<table>/load_batch=<n>/...        the rows
    <warehouse>/load_files/<table>/planned/...    the files of each batch, before it is read
    <warehouse>/load_files/<table>/finished/...   the same with rows, bad lines and state, after it
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.plans.run_log import RunLog
from marketlake.session import path_exists, stored, table_or_empty
from marketlake.sources.landing import table_path
from marketlake.sources.schemas import CORRUPT, RAW_TABLES, selected_tables, with_corrupt

# Files of one batch: bounds the names at the driver and the work that a crash repeats, not what a
# call loads.
FILES_PER_BATCH = 1000

# What the load adds to a raw row. The first three are the table's partitions.
LOADED = [
    T.StructField("load_file", T.StringType()),
    T.StructField("load_batch", T.LongType()),
    T.StructField("quarantined", T.BooleanType()),
    T.StructField("ingest_date", T.DateType()),
]

# States of a finished file.
WHOLE, NO_ROWS, PARTLY, UNREADABLE = "loaded", "empty", "partly_read", "unreadable"

PLANNED = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("dt", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("batch", T.LongType()),
    ]
)
FINISHED = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("dt", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("bad_lines", T.LongType()),
        T.StructField("state", T.StringType()),
        T.StructField("batch", T.LongType()),
    ]
)


@dataclass
class LoadResult:
    """What one call did for one table."""

    table: str
    batches: list[int] = field(default_factory=list)
    files: int = 0
    rows: int = 0
    bad_lines: int = 0
    unreadable_files: int = 0  # of which no row was loaded, or only the rows before a break
    partly_read: list[str] = field(default_factory=list)
    # Files that earlier calls could read in part or not at all. Told, but no failure of this call.
    left_over: list[str] = field(default_factory=list)
    error: str | None = None

    @property
    def failed(self) -> bool:
        return bool(self.bad_lines or self.unreadable_files or self.error)


class LoadFailed(RuntimeError):
    """Raised after everything that could be loaded was."""

    def __init__(self, results: dict[str, LoadResult]):
        self.results = results
        bad = [r for r in results.values() if r.failed]
        super().__init__(
            "; ".join(
                f"{r.table}: {r.bad_lines} line(s) and {r.unreadable_files} file(s) failed to load"
                + (f", partly read: {', '.join(r.partly_read)}" if r.partly_read else "")
                + (f": {r.error}" if r.error else "")
                for r in bad
            )
        )


# Files that can break off part-way.
COMPRESSED = re.compile(r"(?i)\.(gz|gzip|bz2|deflate|zst|lz4|snappy)$")
# What Spark says of a file whose content is at fault, and not its place or the cluster.
BAD_CONTENT = re.compile(
    r"EOFException|ZipException|not a gzip|incorrect header|invalid (block|stored|distance|code|bit)"
    r"|unexpected end|bad block|corrupt|Truncated|ZstdIOException|LZ4Exception|SnappyError",
    re.IGNORECASE,
)


def exactly(name: str) -> str:
    """A path that a reader takes as it is, not as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", name)


def plain(name: str) -> str:
    """One spelling of a local path: listings write `file:/x`, `file:///x`, and escaped characters."""
    return re.sub("^file:/*", "file:/", name)


def broken_off(spark: SparkSession, files: list[str]) -> list[str]:
    """Those of `files` that cannot be read to their end: all are read again, halves if that fails.

    Only a fault in a file's content counts. A lost executor, a missing file or a missing right is
    raised.
    """
    if not files:
        return []
    try:
        (
            spark.read.option("ignoreCorruptFiles", False)
            .option("recursiveFileLookup", True)
            .text([exactly(f) for f in files])
            .agg(F.sum(F.length("value")))
            .collect()
        )
        return []
    except (PySparkException, Py4JJavaError) as exc:
        if not BAD_CONTENT.search(str(exc)):
            raise
        if len(files) == 1:
            return files
    half = len(files) // 2
    return broken_off(spark, files[:half]) + broken_off(spark, files[half:])


def landed_files(spark: SparkSession, root: str, table: str) -> DataFrame:
    """name, dt, length of every landed file. Only listed, not read; no rows before any landed."""
    if not path_exists(spark, table_path(root, table)):
        return spark.createDataFrame([], "name string, dt string, length long")
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(table_path(root, table))
        .filter(F.col("path").contains("/dt="))
    )
    return listed.select(
        F.regexp_replace("path", "^file:/*", "file:/").alias("name"),
        F.regexp_extract("path", "/dt=([^/]*)", 1).alias("dt"),
        "length",
    )


class LoadBook:
    """Planned and finished files of one table."""

    def __init__(self, spark: SparkSession, warehouse: str, table: str):
        self.spark = spark
        self.root = f"{warehouse.rstrip('/')}/load_files/{table}"

    def _save(self, rows: list[tuple], schema: T.StructType, kind: str, batch: int) -> None:
        df = self.spark.createDataFrame(rows, schema)
        df.drop("batch").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{kind}/batch={batch}")

    def planned(self) -> DataFrame:
        return table_or_empty(self.spark, PLANNED, f"{self.root}/planned")

    def finished(self) -> DataFrame:
        """One row for each file that was loaded, or found unreadable."""
        return table_or_empty(self.spark, FINISHED, f"{self.root}/finished")

    def last_batch(self) -> int:
        """The number of the last finished batch, -1 before the first."""
        last = self.finished().agg(F.max("batch").alias("b")).head()["b"]
        return -1 if last is None else last

    def interrupted(self, batch: int, pending: DataFrame) -> list[Row]:
        """Those pending files that a call planned for `batch` and did not finish."""
        planned = self.planned().filter(F.col("batch") == batch).select("name")
        return pending.join(planned, "name", "left_semi").orderBy("dt", "name").collect()

    def plan(self, batch: int, files: list[Row]) -> None:
        rows = [(f["name"], f["dt"], f["length"], batch) for f in files]
        self._save(rows, PLANNED, "planned", batch)

    def finish(self, batch: int, files: list[tuple]) -> None:
        self._save([(*f, batch) for f in files], FINISHED, "finished", batch)

    def pending(self, root: str, table: str) -> DataFrame:
        """Landed files that are not finished."""
        known = self.finished().select("name")
        return landed_files(self.spark, root, table).join(known, "name", "left_anti")

    def left_over(self) -> list[str]:
        """Names of the files that could be read in part or not at all."""
        bad = self.finished().filter(F.col("state").isin(PARTLY, UNREADABLE))
        return sorted(r["name"] for r in bad.select("name").collect())


def _move(spark: SparkSession, root: str, files: list[str], archive_dir: str) -> None:
    """Loaded files to the same place below another folder, by a rename each."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = jvm.org.apache.hadoop.fs.Path
    for name in files:
        source = paths(name)
        fs = source.getFileSystem(conf)
        below = name[name.rindex("/raw/") :]
        target = paths(f"{archive_dir.rstrip('/')}{below}")
        if fs.exists(source):
            fs.mkdirs(target.getParent())
            fs.rename(source, target)


def _write_batch(
    spark: SparkSession, table: str, target: str, batch: int, names: list[str], *, strict: bool
) -> dict[str, int]:
    """Load the files; how many rows were good, and bad. `strict`: a file that breaks off raises."""
    observed = Observation()
    rows = (
        spark.read.schema(with_corrupt(RAW_TABLES[table]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("ignoreCorruptFiles", not strict)
        .option("recursiveFileLookup", True)
        .json([exactly(name) for name in names])
        .withColumns(
            {
                "load_file": F.col("_metadata.file_path"),
                "load_batch": F.lit(batch).cast("bigint"),
                "quarantined": F.col(CORRUPT).isNotNull(),
                "ingest_date": F.to_date("_ingested_at"),
            }
        )
        .observe(
            observed,
            F.count_if(~F.col("quarantined")).alias("good"),
            F.count_if("quarantined").alias("bad"),
        )
    )
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("load_batch", "quarantined", "ingest_date")
        .parquet(target)
    )
    return observed.get


def _load_batch(
    spark: SparkSession, table: str, target: str, batch: int, files: list[Row], result: LoadResult
) -> list[tuple]:
    """Load the files of one batch; (name, dt, rows, bad lines, state) of each."""
    names = {f["name"]: f for f in files}
    packed = [n for n in names if COMPRESSED.search(n)]
    # Read so that a file that breaks off fails the batch, which is then loaded over again without
    # that: files that are whole are read once.
    whole = bool(packed)
    try:
        seen = _write_batch(spark, table, target, batch, list(names), strict=whole)
    except (PySparkException, Py4JJavaError):
        if not whole:
            raise
        whole = False
        seen = _write_batch(spark, table, target, batch, list(names), strict=False)
    result.rows += seen.get("good") or 0
    result.bad_lines += seen.get("bad") or 0

    # Of this batch's own folder, the column of names.
    mine = table_or_empty(spark, loaded_schema(table), f"{target}/load_batch={batch}", basePath=target)
    counted = {
        plain(unquote(r["load_file"])): r
        for r in mine.groupBy("load_file")
        .agg(F.count_if(~F.col("quarantined")).alias("good"), F.count_if("quarantined").alias("bad"))
        .collect()
    }
    suspects = {n for n, f in names.items() if n not in counted and f["length"] > 0}.union(packed)
    broken = set() if whole else set(broken_off(spark, sorted(suspects)))
    done = []
    for name, f in names.items():
        here = counted.get(name)
        state = WHOLE if here else NO_ROWS
        if name in broken:
            state = PARTLY if here else UNREADABLE
        done.append((name, f["dt"], here["good"] if here else 0, here["bad"] if here else 0, state))
    result.partly_read += sorted(n for n in broken if n in counted)
    result.unreadable_files += len(broken)
    result.files += len(done) - len(broken)
    return done


def load_table(
    spark: SparkSession,
    root: str,
    table: str,
    warehouse: str,
    *,
    files_per_batch: int = FILES_PER_BATCH,
    max_files: int | None = None,
    archive_dir: str | None = None,
) -> LoadResult:
    """Load the pending files of one table, the oldest date folder first.

    Lines that do not parse go to `quarantined=true`, so a bad line holds up no other. Of a file
    that breaks off, the rows before the break load. `max_files` bounds what this call takes; the
    rest stays pending. With `archive_dir` files move there when their batch is finished.
    """
    result = LoadResult(table)
    target, book = raw_path(warehouse, table), LoadBook(spark, warehouse, table)
    result.left_over = book.left_over()
    batch = book.last_batch() + 1
    # Listed once: what lands from now on is for the next call.
    pending = stored(book.pending(root, table))
    files = book.interrupted(batch, pending)
    if files:
        pending = pending.filter(~F.col("name").isin([f["name"] for f in files]))
    taken = 0
    while True:
        fresh = not files
        if fresh:
            most = files_per_batch if max_files is None else min(files_per_batch, max_files - taken)
            # The first by date and name: Spark keeps so many rows a task, the driver no more.
            files = pending.orderBy("dt", "name").limit(max(most, 0)).collect()
            if not files:
                return result
            book.plan(batch, files)
        done = _load_batch(spark, table, target, batch, files, result)
        book.finish(batch, done)
        if archive_dir is not None:
            _move(spark, root, [f[0] for f in done], archive_dir)
        result.batches.append(batch)
        taken += len(files)
        last = max((f["dt"], f["name"]) for f in files)
        if fresh:
            pending = pending.filter(F.struct("dt", "name") > F.struct(*map(F.lit, last)))
        batch, files = batch + 1, []


def load_pending(
    spark: SparkSession,
    root: str,
    warehouse: str,
    *,
    include_events: bool = False,
    files_per_batch: int = FILES_PER_BATCH,
    max_files: int | None = None,
    archive_dir: str | None = None,
    strict: bool = True,
    log: RunLog | None = None,
    run_id: str | None = None,
) -> dict[str, LoadResult]:
    """Load the pending files of every selected table; table -> what was done.

    A table that fails does not hold up the next. With `strict`, bad lines, unreadable files and
    failed tables of this call raise `LoadFailed` at the end. With a `log` the counters of the call
    are recorded under `run_id` before that. `max_files` holds for all tables together.
    """
    results: dict[str, LoadResult] = {}
    for table in selected_tables(include_events):
        left = None
        if max_files is not None:
            left = max_files - sum(r.files + r.unreadable_files for r in results.values())
        try:
            results[table] = load_table(
                spark,
                root,
                table,
                warehouse,
                files_per_batch=files_per_batch,
                max_files=left,
                archive_dir=archive_dir,
            )
        except Exception as exc:  # reported with the others at the end
            results[table] = LoadResult(table, error=f"{type(exc).__name__}: {str(exc)[:500]}")
    if log is not None:
        log.record("load-raw", run_id or "load", load_counters(results))
    if strict and any(r.failed for r in results.values()):
        raise LoadFailed(results)
    return results


def load_counters(results: dict[str, LoadResult]) -> dict[str, int]:
    """The counters of one call over all tables."""
    return {
        "files_loaded": sum(r.files for r in results.values()),
        "files_failed": sum(r.unreadable_files for r in results.values()),
        "tables_failed": sum(r.error is not None for r in results.values()),
        "rows_loaded": sum(r.rows for r in results.values()),
        "bad_lines": sum(r.bad_lines for r in results.values()),
    }


def finished_files(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """name, dt, rows, bad_lines, state, batch of every file a load has finished."""
    return LoadBook(spark, warehouse, table).finished()


def raw_path(warehouse: str, table: str) -> str:
    return f"{warehouse.rstrip('/')}/{table}"


def loaded_schema(table: str) -> T.StructType:
    return T.StructType([*with_corrupt(RAW_TABLES[table]).fields, *LOADED])


def loaded_rows(spark: SparkSession, path: str, table: str) -> DataFrame:
    """All rows of a loaded raw table, with what the load added; none before the first load."""
    return table_or_empty(spark, loaded_schema(table), path)


def scan_raw(
    spark: SparkSession, path: str, table: str, batches: list[int] | None = None
) -> DataFrame:
    """Good rows of a loaded raw table in its declared schema, of some load batches or of all."""
    rows = loaded_rows(spark, path, table).filter(~F.col("quarantined"))
    if batches is not None:
        rows = rows.filter(F.col("load_batch").isin(batches))
    return rows.select(*RAW_TABLES[table].fieldNames())


def quarantine(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Lines of the landed files that did not parse."""
    return loaded_rows(spark, path, table).filter("quarantined").select(CORRUPT)
