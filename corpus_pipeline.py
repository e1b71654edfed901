"""The corpus pipeline: stages over documents, each written as Parquet and reread as the next one's input.

All stages but the last return the columns of documents; the last returns pieces with their places in
sequences. Each works on all rows that its predecessor kept. Before a stage the executors give back the memory of the last.

Defined cases of every stage: nulls in any column are kept where a stage keeps the row; other columns of its
input are dropped; an empty table gives an empty one with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataquery.llm.common import relieve_executors, table, written
from strataquery.llm.jaccard import near_duplicates
from strataquery.llm.langid import UNKNOWN, predict, train
from strataquery.llm.linededup import EXACT_DOCS, drop_recurring_lines
from strataquery.llm.mixing import mixed_documents
from strataquery.llm.packing import pack, tokenize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Mean word posterior that a document's language needs to stay.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters (null and empty texts among them), and those in which no language prevails.

    Repeated rows are judged alike; a tie of two languages goes to the first by name. Without any labelled row nothing
    can be told, and all documents go.
    """
    return predict(docs, train(docs)).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring lines; a document of which nothing is left goes.

    The document with the smallest id keeps a line; repeated rows of one id are one document and keep it in each; rows
    without an id are documents by their text. Null texts have no lines and stay.
    """
    relieve_executors(spark)
    kept = drop_recurring_lines(docs, exact_docs=EXACT_DOCS).where("n_dropped = 0 OR n_dropped < n_lines")
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the one with the smallest id. Documents without words or id stay.

    Rows that agree in id and text are one. Several texts under one id are documents of their own, but ids are all that
    names them: each stays if any of them is the smallest of its group.
    """
    relieve_executors(spark)
    groups = near_duplicates(docs, n=5, percent=80)
    stay = groups.where("doc_id = component_id OR (n_shingles = 0 AND doc_id IS NOT NULL)").select("doc_id")
    one = docs.join(stay, "doc_id", "left_semi").select(*COLUMNS).dropDuplicates(["doc_id", "text"])
    return one.union(docs.where("doc_id IS NULL").select(*COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks, three times at most.

    A null source is a source, last in order; documents without words are taken 0 times; rows that differ in nothing
    share their copies. Reruns agree.
    """
    relieve_executors(spark)
    return mixed_documents(docs).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens. Each row is packed, copies too; a null or empty text is the end token alone."""
    import public_tokenizers

    relieve_executors(spark)
    return pack(tokenize(docs, public_tokenizers.path("byte_bpe_50k.json"))).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("language", language), ("lines", lines), ("near", near), ("mixing", mixing), ("packing", packing)]
#: SQL can't express the trained model of the first stage; the tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
