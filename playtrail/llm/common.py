"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.session import materialize

# The separators of a word: space, tab, line feed, vertical tab, form feed, carriage return.
WS_CLASS = r"\x20\x09-\x0D"
WORD_RE = rf"[^{WS_CLASS}]+"
WS_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: str = "text") -> Column:
    """The text of a row; null counts as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def word_array(text: Column) -> Column:
    """The words of a text, in order (built-in functions only)."""
    return F.array_remove(F.split(text, rf"[{WS_CLASS}]+"), "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (case ignored)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def values_table(spark: SparkSession, columns: str, rows: list[str]) -> DataFrame:
    """A small fixed table as a local relation; ``rows`` are SQL row literals."""
    return spark.sql(f"select * from values {', '.join(rows)} as t({columns})")


def discard(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate table of this run that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def sql_text(s: str) -> str:
    """``s`` as a Spark SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected link table ``(a long, b long)``.

    Returns ``(id, comp)`` for every id that appears in a link, ``comp`` being
    the smallest id reachable. Each round gives every id the smallest label of
    its neighbours and then the label of that label (pointer jumping), written
    to the shared folder; only the count of changed labels reaches the driver.
    Hot ids are a partial ``min`` before the shuffle, so a star with any number
    of leaves is no task of its own.
    """
    both = edges.select("a", "b").where("a <> b")
    both = materialize(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), name)
    labels = materialize(both.groupBy(F.col("a").alias("id"))
                         .agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("comp")), name)
    for _ in range(max_rounds):
        near = (both.join(labels.withColumnRenamed("id", "b"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("m")))
        step = labels.join(near, "id").select("id", "comp", F.least("comp", "m").alias("l"))
        jump = labels.select(F.col("id").alias("l"), F.col("comp").alias("lc"))
        new = materialize(step.join(jump, "l", "left")
                          .select("id", F.col("comp").alias("old"), F.coalesce(F.least("l", "lc"), "l").alias("comp")), name)
        labels = new.select("id", "comp")
        if new.where("old <> comp").limit(1).count() == 0:
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
