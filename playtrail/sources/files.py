"""Readers and writers for the reference's file formats (CSV) and our parquet tables."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playtrail.schema import (CLICKS_CSV, EVENT_ORDER, KEY, LABELS_CSV, SPECS_CODED,
                              SPECS_NAMED)
from playtrail.session import bounded_broadcast, materialize

# File splits whose starts may be broadcast (one small row each).
MAX_SPLITS = 200_000


def _csv(spark: SparkSession, path: str, schema) -> DataFrame:
    # event_data holds JSON quoted with doubled quotes: quote and escape are both '"'.
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("mode", "FAILFAST").schema(schema).csv(path))


def read_clicks(spark: SparkSession, path: str, numbered: bool = True) -> DataFrame:
    """Raw events. ``timestamp`` (ISO-8601, Z) becomes ``ts``. With ``numbered``,
    ``src_id`` is the row's place (from 0) in the files, in order of their paths,
    which the reference's tail/first operations rely on."""
    df = _csv(spark, path, CLICKS_CSV)
    if numbered:
        df = in_file_order(df, "src_id")
    return df.withColumn("ts", F.to_timestamp("timestamp")).drop("timestamp")


def in_file_order(df: DataFrame, name: str) -> DataFrame:
    """Number the rows of a file source by file path and then position, the same
    under any split size, file size and packing of splits into tasks.

    Two passes: the rows are written once with their file, the start of their split
    and an id that grows along a task; then each split (one row per split: its rows
    and its first id) gets the number of rows before it, and a row's place is that
    plus its distance from the split's first id."""
    at = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
                   F.monotonically_increasing_id().alias("_mid"))
    rows = materialize(at, "file-order")
    splits = rows.groupBy("_file", "_split").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_file", "_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(splits.select("_file", "_split", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")),
                         "file-splits")
    placed = rows.join(bounded_broadcast(starts, MAX_SPLITS), ["_file", "_split"])
    return placed.withColumn(name, F.col("_before") + F.col("_mid") - F.col("_first")).drop("_file", "_split", "_mid", "_first", "_before")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, LABELS_CSV)


def read_specs(spark: SparkSession, path: str, named: bool = False) -> DataFrame:
    return _csv(spark, path, SPECS_NAMED if named else SPECS_CODED)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_submission(df: DataFrame, path: str, cols: Sequence[str] = (KEY, "accuracy_group")) -> None:
    """Predictions as CSV with a header, one part file per task."""
    write_csv(df.select(*cols), path)


# ---------------------------------------------------------------- S5, S6: the labelled event table

PARTITION = "type"        # what readers ask for first: assessments only, or all play
LAYOUT = "_layout"        # a folder that scans of the table pass over


def _table_name(path: str) -> str:
    return "labelled_" + hashlib.md5(path.encode()).hexdigest()[:16]


def _register(spark: SparkSession, path: str, columns: str, buckets: int, order: Sequence[str]) -> str:
    """The files under ``path`` as a bucketed, partitioned table of this session."""
    name = _table_name(path)
    spark.sql(f"drop table if exists {name}")        # an external table: its files stay
    sorted_by = ", ".join(f"`{c}`" for c in order)
    spark.sql(f"create table {name} ({columns}) using parquet options ('partitionOverwriteMode'='dynamic') partitioned by (`{PARTITION}`) "
              f"clustered by (`{KEY}`) sorted by ({sorted_by}) into {buckets} buckets location '{path}'")
    spark.catalog.recoverPartitions(name)
    return name


def write_labelled(df: DataFrame, path: str, buckets: int | None = None) -> None:
    """Save the labelled event table: partitioned by event type, bucketed by player
    and sorted by player and time within a file, so that a reader of one type opens
    only its folder and joins or groups by player need no exchange.

    Rows are dealt by (bucket, time) ranges: a hot player's rows are written by
    several tasks, as several files of its bucket. The layout is kept beside the
    files, so that another session reads the table the same way."""
    spark = df.sparkSession
    buckets = buckets or min(4096, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [KEY] + [c for c in EVENT_ORDER if c in df.columns]
    df = df.select(*[c for c in df.columns if c != PARTITION], PARTITION)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    layout = json.dumps({"columns": columns, "buckets": buckets, "order": order})
    spark.sql(f"drop table if exists {_table_name(path)}")
    bucket = F.pmod(F.hash(KEY), F.lit(buckets))     # as the writer assigns buckets
    (df.repartitionByRange(bucket, *order).write.mode("overwrite").format("parquet").partitionBy(PARTITION)
       .bucketBy(buckets, KEY).sortBy(*order).option("path", path).saveAsTable(_table_name(path)))
    spark.createDataFrame([(layout,)], "value string").coalesce(1).write.mode("overwrite").text(os.path.join(path, LAYOUT))


def overwrite_labelled(df: DataFrame, path: str) -> None:
    """Replace the event types that ``df`` holds; other types keep their files."""
    spark = df.sparkSession
    stored = read_labelled(spark, path)
    layout = _layout(spark, path)
    bucket = F.pmod(F.hash(KEY), F.lit(layout["buckets"]))
    # The table is registered with dynamic overwrite: only partitions of ``df`` are replaced.
    df.select(*stored.columns).repartitionByRange(bucket, *layout["order"]).write.insertInto(_table_name(path), overwrite=True)


def _layout(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(os.path.join(path, LAYOUT)).first()[0])


def read_labelled(spark: SparkSession, path: str, types: Sequence[str] | None = None) -> DataFrame:
    """The labelled event table as written; ``types`` opens only those types' files.
    Where one player outgrows a task, ``spark.read.parquet`` on the same path reads
    the files without buckets, in splits of any size."""
    layout = _layout(spark, path)
    out = spark.table(_register(spark, path, layout["columns"], layout["buckets"], layout["order"]))
    return out.where(F.col(PARTITION).isin(*types)) if types is not None else out


def preview(df: DataFrame, n: int = 10, order: Sequence[str | Column] = EVENT_ORDER) -> DataFrame:
    """First ``n`` rows in an explicit order (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)
