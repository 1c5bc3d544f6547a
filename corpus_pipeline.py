"""Training-data pipeline over ``documents``: rules, classifier, near-duplicates, benchmark leaks, source mix.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame with the columns of ``docs`` (the last one adds ``copy``, the
number of the copy from 1). ``run`` writes each stage's rows as Parquet in the shared
folder and rereads them for the next, so a lost executor costs one stage at most.

Edge cases are those of the operators: null and empty texts fail the rules, rows
without id or with a repeated one are judged row by row in the near-duplicate and
decontamination stages, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm import decontaminate, mixing, quality_classifier, quality_rules, simhash
from cardlens.llm.columns import space_word_count
from cardlens.llm.queries import MIX_WEIGHTS
from cardlens.session import write_shared
from cardlens.sources.tables import read_table


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rules or leave the fertility bands go."""
    return quality_rules.keep_good(docs)


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier, learnt from the labelled documents of the whole table: documents scored below 0.5 go."""
    model = quality_classifier.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates: the row of the smallest id of each group stays."""
    return simhash.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: rows that contain a benchmark item go. An item of fewer words than a shingle stands in many
    a clean document by chance; the query reports it, here it drops nothing."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"), min_words=decontaminate.WIDTH)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: every document as often as it is drawn."""
    return mixing.mix(docs, space_word_count(F.col("text")), weights=MIX_WEIGHTS)


STAGES = [
    ("quality_rules", keep_by_rules),
    ("quality_classifier", keep_by_classifier),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("source_mixing", mix_sources),
]

# The first stage reads tokenizer vocabularies, which SQL cannot; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
