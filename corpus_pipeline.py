"""The corpus pipeline: toxicity, near-duplicates, contamination, PII, token ids.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All but
the last return the columns of documents. Near-duplicates share at least 0.8 of their
distinct shingles of five words (Jaccard); the rule of op2 is that query's alone.

Odd input: a null or empty text scores as one without known words, is a near-duplicate of
other texts without words, is never contaminated and has no ids; a null id is kept like
any other, and loses against other ids in its group; rows that repeat are near-duplicates
of each other; an empty table gives no rows; columns besides doc_id and text ride along.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm._scratch import discard, owned_by, persist, release_owned
from siltstone.llm.bpe import encode_documents
from siltstone.llm.decontamination import drop_contaminated
from siltstone.llm.pii import replace_pii, session_key
from siltstone.llm.queries import table, vocabulary_path
from siltstone.llm.simhash_similar import keep_one_of_similar
from siltstone.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not score as toxic."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    return keep_one_of_similar(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark window."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; n_chars follows the text."""
    return replace_pii(docs, session_key(spark)).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and the text decoded from them."""
    return encode_documents(docs, vocabulary_path(), decoded=True)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("pii", pii), ("bpe", bpe)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written to the shared folder before the next, which then replaces it and its scratch data."""
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        owner = f"{name}-{uuid.uuid4().hex}"
        with owned_by(owner):
            out = f(spark, docs, sf_dir)
        kept = persist(out, name)
        release_owned(spark, owner)
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
