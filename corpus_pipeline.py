"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read back
as the next stage's docs. All but the last return the columns of documents, extra ones as they are, whatever their names. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracelode.llm import exact, language, mixing, ngram_join, packing
from tracelode.llm.tables import stored, table


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learnt from the corpus; those without letters, or like no learnt language, go.

    So null and empty texts go. Whole texts are judged, a long one in blocks. Equal rows are judged alike, and all of them stay or go. Without
    any document of a known language all go. Null ids are no exception.
    """
    return language.keep_recognised(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of equal texts stays, white space aside: the one with the most code points, of these the smallest doc_id.

    A null text counts as empty, and all empty texts are equal. A null doc_id comes after all others; of rows with one id and
    text any one stays. Long texts are hashed and compared in chunks.
    """
    return exact.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by five-word shingles with a Jaccard likeness of 0.8 or more, the smallest doc_id.

    Null texts and texts without words are linked with nothing, and all stay. Texts of fewer words have all of them as one shingle. A
    null doc_id comes after all others; of rows with one id and text any one stays. Long texts are worked on whole.
    """
    return ngram_join.keep_one_of_each(docs, n=5, num=80, den=100)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture: each file is one stretch of it.

    A null source counts as ''. Null, empty and long texts, null ids and repeated rows stay; rows of one id and text stand together.
    """
    return mixing.in_order(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, the documents of a file in the order in which it holds them.

    A null or empty text is one end token; a long text becomes several pieces. Repeated rows are packed as often as they come.
    """
    return packing.packed(docs)


STAGES = [
    ("language_id", recognised),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixed),
    ("packing", packed),
]

#: Language ID is learnt from the corpus and packing needs a tokenizer: SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
