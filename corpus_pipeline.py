"""A corpus from raw documents to packed sequences.

Every stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents`` (doc_id, text,
lang, source, n_chars) and works on all that the stage before kept. All but the last return
those columns.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulsetide.llm import packing
from pulsetide.llm.common import table, written
from pulsetide.llm.exact_dedup import exact_dedup
from pulsetide.llm.language_id import UNDETERMINED, identify, is_held_out, learn
from pulsetide.llm.ngram_jaccard import jaccard_components
from pulsetide.llm.suffix_dedup import repeated_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, however sure; null texts and those without a letter go."""
    network = learn(docs.filter(~is_held_out("doc_id")).select("doc_id", "text", "lang"))
    found = identify(docs, network)
    return found.filter(F.col("lang_pred") != UNDETERMINED).select(*COLUMNS)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of equal texts: that with the largest id."""
    return exact_dedup(docs).filter("kept").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    groups = jaccard_components(docs.select("doc_id", "text"))
    stays = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("stays")
    )
    return docs.join(stays.distinct(), F.col("doc_id").eqNullSafe(F.col("stays")), "left_semi").select(*COLUMNS)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that start anywhere else too.

    A character that such a string covers in part goes as a whole, and so does a document of
    which only white space remains. All else of the texts stays as it is.
    """
    found = repeated_spans(docs, whole_characters=True)
    left = F.col("left").cast("string")
    cut = F.size("span_starts") > 0
    return (
        found.withColumn("text", F.when(cut, left).otherwise(F.col("text")))
        .withColumn("n_chars", F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
        .filter(~cut | F.col("text").rlike(r"\S"))
        .select(*COLUMNS)
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4,096 tokens."""
    described = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY)).to_str()
    return packing.pack(docs, described)


STAGES = [
    ("language ID", identify_languages),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: No SQL: the first stage is a trained network. Tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for nr, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if nr + 1 < len(STAGES):
            docs = written(docs, f"stage-{nr}")
    return docs
