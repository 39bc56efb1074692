"""From raw documents to a training mixture: five stages, each one operator over all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontam, langid, linededup, mixing, simhash
from ledgerline.llm.common import id_remainder, row_hash, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text is rejected if it has no letter, or if no language is likelier than all others together.
MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a language that is known; learned from the labelled documents of the training fold."""
    docs = docs.select(COLUMNS)
    model = langid.learn(docs, id_remainder(F.col("doc_id"), 4) != 2)
    found = langid.identify(docs, model, COLUMNS)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines in ten or more documents only the first stays; a document that has no other lines goes with them."""
    done = linededup.with_bitmaps(docs.select(COLUMNS), min_docs=linededup.MIN_DOCS, min_chars=linededup.MIN_CHARS, keep_first=True)
    done = done.where((F.col("n_dropped") == 0) | (F.btrim("kept", F.lit(linededup.BLANKS)) != ""))
    text = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_dropped") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return done.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least doc_id."""
    return simhash.one_of_each(docs.select(COLUMNS), words=3, radius=3, segments=2, seed=42)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontam.without_contaminated(docs.select(COLUMNS), table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, with how often each is used (epochs) and its leaf of the source tree."""
    taken = mixing.mixed(docs).select("doc_id", "row", "domain", "n_tokens", "budget", "epochs").dropDuplicates(["row", "doc_id"])
    taken = taken.withColumnsRenamed({"doc_id": "_doc", "row": "_row"})
    named = docs.select(COLUMNS).withColumn("_hash", row_hash(F.col("doc_id"), F.col("text")))
    met = named.join(taken, (named["_hash"] == taken["_row"]) & named["doc_id"].eqNullSafe(taken["_doc"]))
    return met.select(*COLUMNS, "domain", "n_tokens", "budget", "epochs")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mixing", mixture),
]

#: Language scores, fingerprints and alignments can't be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
