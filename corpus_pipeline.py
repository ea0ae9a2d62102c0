"""The corpus pipeline: documents to token blocks in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``docs``, whatever their names.

Null and empty texts have no language and go in the first stage; rows without
an id or source stay, each for itself; of repeated rows the near-dedup keeps
one; an empty table gives no rows at any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, language_id, mixing, simhash, token_output
from ledgerline.llm.common import land, table


# A prediction that contradicts a document's ``lang`` rejects it from this score.
SURE = 0.9


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents of no language (``und``) go, and those whose
    ``lang`` the network contradicts with a score of SURE or more: they are
    not what they are filed as.  An unsure prediction, or no ``lang``, is no
    reason to drop a document.  ``lang`` stays as it came."""
    found = language_id.label(docs, language_id.fit(docs))
    pred, lang = F.col("found.lang_pred"), F.col("row.lang")
    foreign = F.coalesce((pred != lang) & (F.col("found.score") >= SURE), F.lit(False))
    return found.filter((pred != language_id.UNKNOWN) & ~foreign).select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group stays."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: contaminated documents go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: each document as often as the mix takes it."""
    return mixing.take_mix(docs)


def token_blocks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID output: the blocks are written below the shared folder and
    read back: (doc_id, start, n_tokens, ids_crc32)."""
    return token_output.tokenize(docs)


STAGES = [("language_id", known_language), ("simhash_near_dedup", one_of_each),
          ("benchmark_decontamination", uncontaminated), ("mixing", mixed), ("token_output", token_blocks)]

# No stage but decontamination can be said in SQL: a trained network, XXH64
# fingerprints, random rounding and a tokenizer's vocabulary decide.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
