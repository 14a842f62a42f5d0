"""L1, L2, L3: row ordinals in source order and the caps built on them.

Positions come from what cannot shift between two jobs:

* a Parquet row has its file and ``_metadata.row_index``, whatever the splits;
* rows of other formats are staged once as Parquet together with the file and
  split they came from, and every later job reads that copy.

A run is a stretch of consecutive rows of one Parquet file that came from one
source split. One small aggregate counts each run; a running sum over the
runs, in source order, gives their offsets; ordinal = offset + place in the
run. No row is sorted or moved, and a row without an offset raises an error.

Files are ordered by directory, then by part number, then by name, so that
``part-100000`` follows ``part-99999``.

Caps read no further than they have to: of text formats, files are staged in
order, twice as many each time, until the cap is reached (``scan_prefix``); a
Parquet folder may keep its runs beside it (``write_run_index``), which turn an
ordinal bound into a list of files and a bound on row indexes (``scan_head``).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatmill.session import stage

SRC_FILE, SRC_BLOCK, SRC_ROW = "_src_file", "_src_block", "_src_row"
# where the rows of a staged or tokenized table came from
FROM_FILE, FROM_BLOCK = "src_file", "src_block"
# rows (about 100 bytes each) up to which the run table is broadcast; beyond,
# the join shuffles, with the same result
MAX_BROADCAST_RUNS = 500_000
# the runs of a folder, in a folder whose name readers of the other skip
RUN_INDEX = "_runs"
# files up to which a capped scan names them one by one; beyond, it reads the folder
MAX_LISTED_FILES = 10_000
_BLOCK_ROWS = 1 << 16


def scan_with_position(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Read ``path`` and keep each row's file and split; of Parquet, its row index."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    where = [F.col("_metadata.file_path").alias(SRC_FILE), F.col("_metadata.file_block_start").alias(SRC_BLOCK)]
    if fmt == "parquet":
        where.append(F.col("_metadata.row_index").alias(SRC_ROW))
    return reader.load(path).select("*", *where)


def file_order(path: Column) -> Column:
    """What files sort by: directory, part number, name."""
    part = F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1)
    return F.struct(F.regexp_replace(path, r"/[^/]*$", ""), F.when(part == "", F.lit(-1)).otherwise(part.try_cast("long")), path)


def positions_of(df: DataFrame) -> list[str]:
    """The position columns of a positioned scan; row-dropping, order-keeping
    steps carry them along."""
    return [c for c in (SRC_FILE, SRC_BLOCK) if c in df.columns]


def source_columns(df: DataFrame) -> DataFrame:
    """Position columns under the names that staged tables keep them by."""
    return df.withColumnsRenamed({SRC_FILE: FROM_FILE, SRC_BLOCK: FROM_BLOCK}).drop(SRC_ROW)


def stage_in_order(df: DataFrame, label: str = "ordered") -> DataFrame:
    """Write the rows of a positioned scan (after narrow steps) once, and read
    them with positions that stay as they are."""
    path = stage(source_columns(df), label)
    return scan_with_position(df.sparkSession, path)


def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Append the exact source-order ordinal, 0 .. n-1.

    ``df``: a positioned scan with all its rows (a Parquet one, or one of
    another format, which is staged first).
    """
    if SRC_ROW not in df.columns:
        df = stage_in_order(df)
    keys = [SRC_FILE, "_file", "_block"]
    runs = df.sparkSession.read.parquet(stage(_offsets(_runs(df)).select(*keys, "_row0", "_off"), "runs"))
    return _numbered(df, runs, name)


def _with_run(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Appends the source file and split of each row's run; and the columns that told them."""
    moved = [c for c in (FROM_FILE, FROM_BLOCK) if c in df.columns]
    return df.withColumns({"_file": F.coalesce(*[F.col(c) for c in moved[:1]], F.col(SRC_FILE)),
                           "_block": F.coalesce(*[F.col(c) for c in moved[1:]], F.lit(-1).cast("long"))}), moved


def _runs(df: DataFrame, *also: Column) -> DataFrame:
    """One row a run: its keys, number of rows and first row index."""
    x, _ = _with_run(df)
    keys = [SRC_FILE, "_file", "_block"]
    runs = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(SRC_ROW).alias("_row0"), F.max(SRC_ROW).alias("_row1"), *also)
    whole = F.when(F.col("_row1") - F.col("_row0") + 1 == F.col("_n"), F.col("_n")).otherwise(
        F.raise_error(F.lit("with_ordinal: rows are missing from the scan")).cast("long"))
    return runs.withColumn("_n", whole).drop("_row1")


def _offsets(runs: DataFrame) -> DataFrame:
    """Appends the number of rows before each run, in source order."""
    in_order = Window.orderBy(file_order(F.col("_file")), "_block", file_order(F.col(SRC_FILE)), "_row0")
    return runs.withColumn("_off", F.coalesce(F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def _numbered(df: DataFrame, runs: DataFrame, name: str) -> DataFrame:
    """Ordinals from a staged table of runs (keys, _row0, _off)."""
    x, moved = _with_run(df)
    small = runs.count() <= MAX_BROADCAST_RUNS
    out = x.join(F.broadcast(runs) if small else runs, [SRC_FILE, "_file", "_block"], "left")
    place = F.when(F.col("_off").isNull(), F.raise_error(F.lit("with_ordinal: a row without an offset")).cast("long")).otherwise(
        F.col("_off") + F.col(SRC_ROW) - F.col("_row0"))
    return out.withColumn(name, place.cast("long")).drop("_file", "_block", "_row0", "_off", *moved)


def _files(df: DataFrame) -> list[str]:
    """The files of a scan in source order, as ``file_order`` has it."""
    def place(path):
        folder, _, file = path.rpartition("/")
        part = re.match(r"part-(\d+)", file)
        return folder, int(part.group(1)) if part else -1, path
    return [unquote(path) for path in sorted(df.inputFiles(), key=place)]


def scan_prefix(spark: SparkSession, path: str, cap: int, fmt: str = "json", schema=None, narrow: Callable[[DataFrame], DataFrame] | None = None,
                name: str = "ordinal", **options) -> DataFrame:
    """The first ``cap`` rows of files of any format in source order (L1, L3),
    with their ordinal. ``narrow``: a step that keeps the order and the position
    columns and may drop rows; the cap counts what it leaves.

    Files are staged in order, as many again each time, until the rows suffice:
    at most twice the files that hold them (of one file, all of it) are opened.
    """
    if cap < 1:
        raise ValueError(f"cap must be >= 1, got {cap}")
    reader = spark.read.format(fmt).options(**options)
    files = _files((reader.schema(schema) if schema is not None else reader).load(path))
    parts, have, at = [], 0, 0
    while at < len(files) and have < cap:
        some = scan_with_position(spark, files[at:max(1, 2 * at)], fmt, schema, **options)
        staged = stage_in_order(narrow(some) if narrow else some, "prefix")
        numbered = with_ordinal(staged, name)
        parts.append(numbered.withColumn(name, F.col(name) + F.lit(have)))
        have, at = have + staged.count(), max(1, 2 * at)
    if not parts:
        empty = scan_with_position(spark, path, fmt, schema, **options)
        return with_ordinal(narrow(empty) if narrow else empty, name)
    return reduce(lambda a, b: a.unionByName(b), parts).where(F.col(name) < F.lit(int(cap)))


def write_run_index(spark: SparkSession, path: str) -> None:
    """Keep the runs of a Parquet folder of part files beside them: by file
    name (the folder may move) and size (a rewritten folder shows)."""
    rows = scan_with_position(spark, path).withColumn("_size", F.col("_metadata.file_size"))
    runs = _offsets(_runs(rows, F.max("_size").alias("_size")))
    runs.withColumn("_name", _name(F.col(SRC_FILE))).drop(SRC_FILE).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{RUN_INDEX}")


def _name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]*$", 0)


def read_run_index(spark: SparkSession, path: str) -> DataFrame | None:
    """The kept runs, or None if there are none or the folder's files are others."""
    try:
        runs = spark.read.parquet(f"{path.rstrip('/')}/{RUN_INDEX}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    kept = runs.select("_name", "_size").distinct()
    now = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(_name(F.col("path")).alias("_name"), F.col("length").alias("_size"))
    rows = spark.read.parquet(path).select(_name(F.col("_metadata.file_path")).alias("_name")).distinct()     # of files with rows
    now = now.join(rows, "_name", "left_semi")
    return runs if now.exceptAll(kept).isEmpty() and kept.exceptAll(now).isEmpty() else None


def scan_head(spark: SparkSession, path: str, cap: int, schema=None, name: str = "ordinal") -> DataFrame | None:
    """L3 on a Parquet folder with a run index: its first ``cap`` rows with their
    ordinal. Only files that hold such rows are scanned, each up to a row index.
    None without an index, or where the files are too many to name."""
    if cap < 1:
        raise ValueError(f"cap must be >= 1, got {cap}")
    index = read_run_index(spark, path)
    if index is None:
        return None
    runs = index.where(F.col("_off") < F.lit(int(cap)))
    upto = F.least(F.col("_n"), F.lit(int(cap)) - F.col("_off")) + F.col("_row0") - 1
    files = runs.groupBy("_name").agg(F.max(upto).alias("upto"), F.max("_n").alias("n")).limit(MAX_LISTED_FILES + 1).collect()
    if not files or len(files) > MAX_LISTED_FILES:
        return None
    last = {r["_name"]: r["upto"] for r in index.join(runs.select("_name").distinct(), "_name", "left_semi").groupBy("_name").agg(
        F.max(F.col("_row0") + F.col("_n") - 1).alias("upto")).collect()}
    df = scan_with_position(spark, [f"{path.rstrip('/')}/{r['_name']}" for r in files], "parquet", schema)
    for r in files:
        if r["upto"] < last[r["_name"]]:          # the cap ends within it
            df = df.where((_name(F.col(SRC_FILE)) != F.lit(r["_name"])) | (F.col(SRC_ROW) <= F.lit(r["upto"])))
    named = df.select(F.col(SRC_FILE)).distinct().withColumn("_name", _name(F.col(SRC_FILE)))
    staged = spark.read.parquet(stage(runs.join(named, "_name").select(SRC_FILE, "_file", "_block", "_row0", "_off"), "runs"))
    return _numbered(df, staged, name).where(F.col(name) < F.lit(int(cap)))


def cap_condition(rows: DataFrame, cap: int) -> Column:
    """Whether a row of a positioned Parquet scan, after any filters, is one of
    the first ``cap`` in source order.

    Rows are counted by file, then by blocks of row indexes of the one file
    that the cap ends in, whose first rows (of one block) are looked up. The
    condition's part on the file alone lets the scan skip later files.
    """
    if cap < 1:
        raise ValueError(f"cap must be >= 1, got {cap}")
    rows = rows.select(SRC_FILE, SRC_ROW)
    order = file_order(F.col(SRC_FILE))
    files = rows.groupBy(SRC_FILE).agg(F.count(F.lit(1)).alias("n"))
    files = files.withColumn("upto", F.sum("n").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
    last = files.where(F.col("upto") >= F.lit(int(cap))).orderBy("upto").first()
    if last is None:
        return F.lit(True)
    within = rows.where(F.col(SRC_FILE) == F.lit(last[SRC_FILE]))
    block = F.floor(F.col(SRC_ROW) / _BLOCK_ROWS).alias("b")
    rest, at = cap - (last["upto"] - last["n"]), 0
    for b, n in sorted((r["b"], r["n"]) for r in within.groupBy(block).agg(F.count(F.lit(1)).alias("n")).collect()):
        at = b
        if rest <= n:
            break
        rest -= n
    first = within.where(block == F.lit(at)).orderBy(SRC_ROW).limit(rest).agg(F.max(SRC_ROW)).first()[0]
    end = file_order(F.lit(last[SRC_FILE]))
    return (order <= end) & ((order < end) | (F.col(SRC_ROW) <= F.lit(first)))


def prefix_cap(df: DataFrame, cap: int | None, ordinal: str = "ordinal") -> DataFrame:
    """Keep the first ``cap`` rows in source order (L1). ``df`` is a positioned
    scan, after any filters, or has an ordinal; ``cap=None`` keeps all rows."""
    if cap is None:
        return df
    if cap < 1:
        raise ValueError(f"cap must be >= 1, got {cap}")
    if ordinal not in df.columns and SRC_ROW in df.columns and FROM_FILE not in df.columns:
        return df.where(cap_condition(df, cap))
    if ordinal not in df.columns:
        df = with_ordinal(df, ordinal)
    return df.where(F.col(ordinal) < F.lit(int(cap)))


def mix_caps(train_size: int) -> dict[str, int]:
    """Per-source caps: v1 gets N, the other two ``max(1, N // 2)`` (L2)."""
    if train_size < 1:
        raise ValueError(f"train_size must be >= 1, got {train_size}")
    half = max(1, train_size // 2)
    return {"squad": train_size, "squad_v2": half, "trivia_qa": half}


def head_cap(df: DataFrame, max_samples: int | None, ordinal: str = "ordinal") -> DataFrame:
    """``select(range(min(len, max_samples)))``; a falsy cap means no cap (L3)."""
    if not max_samples:
        return df
    return prefix_cap(df, int(max_samples), ordinal)
