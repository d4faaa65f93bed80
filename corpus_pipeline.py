"""Training-data pipeline over ``documents``: quality rules, exact dedup,
near-dedup, mixing, packing.

Each stage takes the rows its predecessor kept, written as Parquet in the
shared folder and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame

from campo.llm import exact, mixing, near, packing, quality
from campo.llm.common import stage, table
from campo.llm.queries import tokenizer


def quality_rules(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept; the model is trained on the
    labelled rows among ``docs``."""
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.survivors(docs)


def near_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near.survivors(docs)


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document taken twice is two rows."""
    return mixing.mixed(docs)


def pack_sequences(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents with their place in a sequence."""
    return packing.packed(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenizer, trained classifier and signatures have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
