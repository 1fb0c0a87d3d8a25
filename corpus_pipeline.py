"""From raw documents to an ordered training mixture, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of their input, whatever they are called. An empty table gives
an empty one. ``run`` writes every stage's result to the
shared folder and reads it again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import decontamination, mixing, near_duplicates, secrets, toxicity
from cohortlens.llm.common import table
from cohortlens.session import cut_lineage


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the model, learned from the labelled ones, does not predict as toxic.

    Null and empty texts stay, repeated rows each; very long texts are read whole. Without
    labels of both kinds everything stays.
    """
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the least id.

    Of repeated rows one stays; rows without words (null, empty) all stay. Whole texts
    are compared, and a pair exactly at the threshold is a pair.
    """
    return near_duplicates.drop_near_duplicates(docs)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items.

    Null and empty texts are clean and stay, repeated rows each; whole texts are
    scanned. With no items everything stays.
    """
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts.

    Null and empty texts stay as they are, repeated rows each; whole texts are scanned.
    """
    return secrets.mask_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture, with mix_block and mix_slot.

    If ``docs`` has columns of those names, they stay, and the new ones are called
    mix_block_2, mix_slot_2 and so on. A null source is a source; null texts have no
    size and stay; equal deadlines go to the source that comes first; a very long text is
    one block.
    """
    block, slot = (_free(name, docs.columns) for name in ("mix_block", "mix_slot"))
    packed = docs.select(
        "doc_id", "source", "text", F.struct(*(docs[c] for c in docs.columns)).alias("_document")
    )
    mixed = mixing.mix_sources(packed, carry=("_document",))
    return (
        mixed.select("_document.*", F.col("block").alias(block), F.col("slot").alias(slot))
        .repartitionByRange(slot)
        .sortWithinPartitions(slot, "doc_id")
    )


def _free(name: str, taken: list[str]) -> str:
    """``name``, or the first of name_2, name_3, .. that is not taken."""
    known, number, new = {c.lower() for c in taken}, 1, name
    while new in known:
        number += 1
        new = f"{name}_{number}"
    return new


STAGES = [
    ("toxicity", reject_toxic),
    ("jaccard_join", keep_one_of_each),
    ("decontamination", remove_benchmarks),
    ("secret_scan", mask_secrets),
    ("source_mix", mix),
]

#: Two stages learn or sample a model, which SQL cannot express; tests use plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
