"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playtrail.llm import oracles
from playtrail.llm.common import table
from playtrail.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@query("op1_quality_rules", oracles.quality_rules())
def op1(spark, sf_dir):
    from playtrail.llm.quality_rules import quality_rules
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


@query("op2_secret_scan", oracles.secret_scan())
def op2(spark, sf_dir):
    from playtrail.llm.secrets import digest_columns, secret_scan
    return digest_columns(secret_scan(table(spark, sf_dir, "documents")))


@query("op10_sharding")
def op10(spark, sf_dir):
    from playtrail.llm.sharding import shard
    return shard(table(spark, sf_dir, "documents"))


@query("op9_ngram_jaccard_join")
def op9(spark, sf_dir):
    from playtrail.llm.jaccard_join import jaccard_join
    return jaccard_join(table(spark, sf_dir, "documents"), words=3, percent=90).select(
        "doc_id", "n_shingles", "component_id")


@query("op6_warc", oracles.warc())
def op6(spark, sf_dir):
    from playtrail.llm.warc import archive
    return archive(table(spark, sf_dir, "pages"))


@query("op7_source_mixing")
def op7(spark, sf_dir):
    from playtrail.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents"))


@query("op3_quality_classifier")
def op3(spark, sf_dir):
    from playtrail.llm.quality_model import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_nearest_neighbours")
def op8(spark, sf_dir):
    from playtrail.llm.neighbours import nearest
    return nearest(table(spark, sf_dir, "embeddings"))


@query("op5_personal_data")
def op5(spark, sf_dir):
    from playtrail.llm.pii import digest_columns, personal_data
    return digest_columns(personal_data(table(spark, sf_dir, "documents")))


@query("op4_sentencepiece")
def op4(spark, sf_dir):
    from pyspark.sql import functions as F

    from playtrail.llm.sentencepiece_codes import Pieces, decode, encode
    pieces = Pieces()
    coded = decode(encode(table(spark, sf_dir, "documents"), pieces), pieces)
    return coded.select("doc_id", F.size("codes").cast("long").alias("n_codes"), "codes",
                        (F.col("decoded") == F.col("text")).alias("round_trip"))


@query("op11_url_filter", oracles.url_filter())
def op11(spark, sf_dir):
    from playtrail.llm.url_reputation import page_outcomes, url_filter
    return url_filter(table(spark, sf_dir, "pages"), page_outcomes(table(spark, sf_dir, "labels")))


@query("op13_periodic_runs")
def op13(spark, sf_dir):
    from playtrail.llm.periodic_runs import digest_columns, find_runs, with_planted_periods
    return digest_columns(find_runs(with_planted_periods(table(spark, sf_dir, "documents"))))


@query("op12_phrase_collocations", oracles.collocations())
def op12(spark, sf_dir):
    from playtrail.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))
