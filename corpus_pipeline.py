"""A training corpus from `documents`: five stages, each written and reread.

Every stage is one of the operators of `tastes.llm`; its decisions take
effect before the next one reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastes.llm.bpe import encode
from tastes.llm.common import DOCUMENT_COLUMNS, Scratch, table
from tastes.llm.decontaminate import reject_contaminated
from tastes.llm.minhash import near_duplicates
from tastes.llm.substring import substring_dedup
from tastes.llm.toxicity import fit_lexicon, reject_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity score reaches the threshold."""
    lexicon = fit_lexicon(docs, table(spark, sf_dir, "labels"))
    return reject_toxic(docs.select(*DOCUMENT_COLUMNS), lexicon)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles, 0.8).

    Of rows that repeat a doc_id one stays; rows without a doc_id all stay.
    """
    scratch = Scratch(spark, "pipeline-near")
    found = near_duplicates(docs, shingle_words=5, percent=80, scratch=scratch)
    gone = scratch.save(
        found.where("not kept").select("doc_id").distinct(), "gone"
    )
    kept = docs.join(gone, "doc_id", "left_anti")
    repeated = scratch.save(
        kept.where("doc_id is not null").groupBy("doc_id").count().where("count > 1"), "repeated"
    )
    if not repeated.limit(1).count():
        return kept.select(*DOCUMENT_COLUMNS)
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    others = kept.join(repeated, "doc_id", "left_anti")
    return others.select(*DOCUMENT_COLUMNS).union(once.select(*DOCUMENT_COLUMNS))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines and passages that an earlier document holds; n_chars follows."""
    cut = substring_dedup(docs.select(*DOCUMENT_COLUMNS))
    return cut.withColumn(
        "n_chars",
        F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")),
    ).select(*DOCUMENT_COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item's question and answer."""
    return reject_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the packed token ids and their number."""
    encoded = encode(docs.select(*DOCUMENT_COLUMNS))
    return encoded.withColumn("n_tokens", (F.length("ids") / 4).cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_level_bpe", tokenize),
]

# No SQL expresses the lexicon, the banding or the merges; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`, each written as Parquet and reread."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{n}-{name}")
        if n:
            scratch.drop(f"{n - 1}-{STAGES[n - 1][0]}")
    return docs
