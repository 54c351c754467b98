"""Corpus pipeline: five stages over ``documents``, each written as Parquet and
reread as the next stage's input. All stages but the last return the columns of
``documents``; the last returns each document's place in the mixture, its codes
and the text they decode to, in the order of the mixture.

Every stage keeps columns it does not know, whatever their names, and gives no
rows for an empty table.
"""

from __future__ import annotations

import re
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.llm.common import fresh, whole_text
from playtrail.llm.jaccard_join import one_per_group
from playtrail.llm.mixing import in_mixture_order
from playtrail.llm.pii import sanitise
from playtrail.llm.quality_rules import quality_rules
from playtrail.llm.sentencepiece_codes import Pieces, decode, encode
from playtrail.session import bounded_broadcast, configure, materialize

#: Groups of approximate duplicates, SentencePiece codes and PMI are not expressible in one SQL text.
ORACLE_SQL = None

REJECTED_ROWS = 500_000   # rejected documents that may be broadcast; a shuffle join beyond


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go. The verdict follows from the
    text alone, so it is joined back by the text's 128-bit digest. A null or empty
    text has too few words and goes; repeated rows go or stay together; a null key
    changes nothing; a text of any length is judged whole."""
    key, at = fresh(docs, "text_key", "rejected_key")
    keyed = docs.withColumn(key, F.md5(whole_text("text").cast("binary")))
    # Written before it is filtered: a filter would be pushed into the statistics and repeat them.
    verdict = materialize(quality_rules(keyed.select(F.col(key).alias("doc_id"), "text")).select(
        F.col("doc_id").alias(at), "kept"), "quality-verdicts")
    gone = materialize(verdict.where(~F.col("kept")).select(at).distinct(), "rejected")
    return keyed.join(bounded_broadcast(gone, REJECTED_ROWS), F.col(key) == F.col(at), "left_anti").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, 0.8.
    The smallest key of a group stays, of equal rows one, and of rows with words that
    share a key one, as a key names one document. Texts without words (null
    or empty) are in no group; a shorter text than a shingle is one shingle; a null key
    only stays where its group has no other."""
    return one_per_group(docs, words=5, percent=80)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that reveal it are replaced in the text; every row stays.
    A null text stays null and an empty one empty; equal texts are rewritten alike; a
    text of any length is rewritten whole."""
    return sanitise(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture of sources. A null source is a source
    of its own, a null key is ordered like any other, and equal rows stand together."""
    return in_mixture_order(docs)


def codes_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece codes of every document and the text they decode to, sorted by
    ``place``: the row's place (from 0) in the files that ``mixing_stage`` wrote.
    Spark packs files by size and encoding moves rows, so the place goes with the row.
    A null text is coded as the empty text; repeated rows have places of their own."""
    pieces = Pieces()
    at = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("file__"), F.col("_metadata.row_index").alias("row__"))
    # One row per file; files of one task, should it write several, differ after its number.
    rows = {r["file__"]: r["count"] for r in at.groupBy("file__").count().collect()}
    files = sorted(rows, key=lambda f: (int(re.match(r"part-(\d+)", f)[1]), f))
    starts = list(accumulate((rows[f] for f in files), initial=0))
    start = spark.createDataFrame(list(zip(files, starts)), "file string, start long")
    keyed = at.select(F.struct("file__", "row__", "doc_id").alias("doc_id"), "text")
    coded = encode(keyed, pieces).join(bounded_broadcast(start), F.col("doc_id.file__") == F.col("file"))
    coded = coded.select(F.col("doc_id.doc_id").alias("doc_id"), (F.col("start") + F.col("doc_id.row__")).alias("place"), "codes")
    # Places are dense, so equal runs of them are the sorted partitions: no sampling, which would encode twice.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    run_of = F.floor(F.col("place") * tasks / max(starts[-1], 1)).cast("int")
    coded = coded.repartitionById(tasks, run_of).sortWithinPartitions("place")
    return decode(coded, pieces).select("doc_id", "place", "codes", "decoded")


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("personal_data", personal_data_stage),
    ("source_mixing", mixing_stage),
    ("sentencepiece", codes_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``: doc_id, place in the mixture, codes and
    decoded text, in the order of the places."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
