"""A training corpus from raw documents: language, near duplicates, secrets, mixture, packed sequences.

Each stage reads what the one before has written to the shared folder. All stages but the last return the columns of
documents; the last one returns a row per piece of a packed sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from signalbase.llm import language, mixing, packing, secrets, simhash
from signalbase.llm.common import documents, ship
from signalbase.llm.queries import vocabulary
from signalbase.session import stage


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that have no language or contradict the declared one beyond doubt.

    Only the rejected rows' ids and text hashes are joined back; Spark broadcasts them if they are few, else it shuffles.
    """
    ship(spark)
    found = language.identify(docs.select(*language.evidence(
        [F.col("doc_id"), F.xxhash64("text").alias("hash")], F.col("text"), F.col("lang"), host=F.col("source"))))
    out = found.where(language.is_rejected()).select("doc_id", "hash").distinct()
    return docs.join(out, docs["doc_id"].eqNullSafe(out["doc_id"]) & (F.xxhash64(docs["text"]) == out["hash"]), "left_anti")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the fingerprints of op1 link: the one with the smallest id, or any where none has an id.

    A row is named by its id and the hash of its text, so rows that share an id but not their text are told apart, and
    rows without an id too. Of rows equal in both, one stays.
    """
    ship(spark)
    name = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    found = stage(simhash.near_duplicates(docs.select(name.alias("doc_id"), "text")), "linked")
    gone = stage(found.where("doc_id <> component_id").select(F.col("doc_id").alias("_name")).distinct(), "gone")
    kept = docs.join(gone, name == F.col("_name"), "left_anti")
    doubled = stage(found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("_name")).count()
                    .where("count > 1").select("_name"), "doubled")
    if doubled.isEmpty():
        return kept
    firsts = kept.join(doubled, name == F.col("_name"), "left_semi").withColumn("_name", name).dropDuplicates(["_name"]).drop("_name")
    return kept.join(doubled, name == F.col("_name"), "left_anti").unionByName(firsts)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts masked."""
    ship(spark)
    return secrets.mask_secrets(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, left out or cut so that each source has its share of all words."""
    return mixing.apply_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens, each window mixed from all sources."""
    ship(spark)
    return packing.pack(docs, *vocabulary())


STAGES = [("language ID", by_language), ("SimHash near-dedup", without_near_duplicates), ("secret scans", without_secrets),
          ("mixing to target weights", mixed), ("packing", packed)]

#: Fingerprints, the trained models and token ids are beyond SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``, each one's rows written as Parquet and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
