"""A corpus made ready for training: documents in, packed sequences of tokens out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All but the
last return the columns of documents.

1. toxicity: documents with a score of 0.5 or more go;
2. jaccard: of each component of near copies the document with the least doc_id stays;
3. pii: personal data in the texts becomes surrogates;
4. mixing: sources are brought to their target weights, documents stay, go or come twice;
5. packing: all texts in windows of 2048 tokens, one row per piece, with its token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contigo.llm import jaccard, mixing, packing, pii, toxicity
from contigo.llm.common import Staging, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels"), toxicity.fold(5) != 0)
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one_each(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.with_surrogates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_documents(docs, mixing.mix_decisions(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, packing.word_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard", drop_near_copies),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenisation, learned scores and keyed surrogates have no SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, of all documents of sf_dir."""
    stage, docs = Staging(spark, "pipeline"), read_table(spark, sf_dir, "documents")
    for k, (name, function) in enumerate(STAGES):
        docs = stage.write(function(spark, docs, sf_dir), name, free=True)
        if k:
            stage.drop(STAGES[k - 1][0])
    return docs
