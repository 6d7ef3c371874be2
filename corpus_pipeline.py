"""From raw documents to token shards: five stages, each on all that the one before kept.

1. ``toxicity``: documents that the classifier rejects go.
2. ``near_dedup``: of each group of near-duplicates the smallest ``doc_id`` stays (five-word shingles, 0.8); a row goes by its
   id and text, so texts that share an id are told apart, and of rows equal in both one stays.
3. ``decontaminate``: documents that hold a benchmark item go.
4. ``mix``: each source is taken as often as its target asks, the rest as a weighted sample.
5. ``token_output``: the mix becomes binary shards with an index; the result is read back from them.

Null and empty texts, null ids and sources, repeated rows and extra columns pass through as the operators
define; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.common import stored, table
from tidemill.llm.decontaminate import without_leaks
from tidemill.llm.mixing import mixed_documents
from tidemill.llm.near_dedup import without_near_duplicates
from tidemill.llm.token_output import token_output
from tidemill.llm.toxicity import toxicity_score, train

REJECTED_FROM = 0.7


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train(spark, docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity_score(model) < REJECTED_FROM)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(spark, docs, width=5, similarity=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(spark, docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(spark, docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_output(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_output", tokens),
]

#: Models, sketches and tokenizers are beyond SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
