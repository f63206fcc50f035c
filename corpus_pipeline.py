"""A corpus in stages; each one's Parquet is the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkweave.llm import langid
from talkweave.llm.common import load, written
from talkweave.llm.decontaminate import drop_contaminated
from talkweave.llm.mixing import mix
from talkweave.llm.sharding import shard
from talkweave.llm.simhash import drop_near


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones among them teach; those without letters go."""
    return langid.keep_identified(docs, langid.train(langid.learnt(docs)))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: four-word shingles, four bits."""
    return drop_near(docs, width=4, bits=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty stands in a benchmark window."""
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source near its share of the words."""
    return mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of equal size in random order."""
    return shard(docs)


STAGES = [
    ("language ID", identified),
    ("SimHash near-dedup", deduplicated),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]

#: SQL has no Viterbi, no XXH64 and no draw of a communication matrix
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
