"""The corpus pipeline: stages over documents, each written as Parquet and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspire.llm.bpe_codec import encode
from larkspire.llm.common import cut, read_table
from larkspire.llm.decontaminate import remove_leaks
from larkspire.llm.line_dedup import dedup_lines
from larkspire.llm.minhash_dedup import keep_one_of_each
from larkspire.llm.toxicity import reject_toxic, train, training_rows


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones that aren't held out, finds toxic go.

    Null and empty texts are judged as the empty text and stay. Repeated rows are judged alike. Without labels of both classes
    nothing goes. All columns pass through.
    """
    return reject_toxic(docs, train(training_rows(docs), training_rows(read_table(spark, sf_dir, "labels"))))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more stay where they come first only, so that no content is lost with its copies.

    n_chars becomes the length of the text that is left. Null and empty texts stay as they are; rows that repeat an id and text
    count as one document and lose the same lines. All columns pass through.
    """
    done = dedup_lines(docs, min_docs=10, min_chars=1, keep_first=True)
    left = F.when(F.col("n_dropped") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", left).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    Null texts and texts without words are near nothing and stay, as do rows with a null id, and all rows of an id that is kept.
    All columns pass through.
    """
    return keep_one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none. Repeated rows are judged alike; an empty benchmark takes nothing away. All columns pass
    through.
    """
    return remove_leaks(spark, docs, read_table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text decoded from them, a row for each row. Null and empty texts have no tokens."""
    return encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("BPE encoding", encode_tokens),
]

#: A trained classifier, MinHash and a tokenizer have no form in SQL; tests/llm holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
