"""The corpus pipeline: language ID, near duplicates, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm import language_id, mixing, ngram_join, packing
from lakeloom.llm.common import read_table, settle
from lakeloom.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language or several; those in which none is found go, and lang becomes the predicted first one."""
    found = language_id.predict_held_out(docs, carry=("text", "source", "n_chars"))
    found = found.where(f"lang_pred <> '{language_id.UNKNOWN}'")
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest number of each class of near duplicates.

    Where numbers are missing or repeated, every row is a document of its own: null numbers come
    after all others, and of equal ones the first row of the table stays.
    """
    if ngram_join.uniquely_numbered(docs):
        classes = ngram_join.jaccard_classes(docs)
        return _with(docs, classes.where("doc_id = component_id").select("doc_id")).select(*COLUMNS)
    rows = settle(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()))
    classes = ngram_join.jaccard_classes(rows.select(F.col("row").alias("doc_id"), "text"))
    classes = classes.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", "doc_id"), "row")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    first = classes.groupBy("component_id").agg(F.min(order).alias("first")).select("first.row")
    return rows.join(settle(first).hint("merge"), "row").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it, those with missing or repeated numbers too."""
    copies = mixing.mix(docs).where("copies > 0")
    if ngram_join.uniquely_numbered(docs):
        taken = _with(docs, copies.select("doc_id", "copies"))
    else:
        # Rows of one number, source and size are alike to the mix: each takes one of their decisions. No text is sorted.
        alike = Window.partitionBy("doc_id", "source", "size")
        rows = settle(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()))
        sized = rows.select("row", "doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
        mine = sized.withColumn("turn", F.row_number().over(alike.orderBy("row"))).alias("d")
        told = settle(copies.withColumn("turn", F.row_number().over(alike.orderBy(F.desc("copies"), "nth"))).select("doc_id", "source", "size", "turn", "copies")).hint("merge").alias("c")
        same = F.lit(True)
        for c in ("doc_id", "source", "size", "turn"):
            same &= F.col(f"d.{c}").eqNullSafe(F.col(f"c.{c}"))
        taken = rows.join(settle(mine.join(told, same).select("d.row", "c.copies")).hint("merge"), "row")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece with its token ids and its place in a sequence."""
    return packing.pack_documents(docs, tokenizer_path(), with_ids=True)


def _with(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """docs with the decisions of their numbers, which must be unique and not null.

    There are as many decisions as documents, so they are never sent whole to every task: both
    sides are dealt by number, at any size.
    """
    return docs.join(settle(decisions).hint("merge"), "doc_id")


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", keep_one_of_each),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]
#: No stage but the mix is SQL, and the mix draws lots: tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = settle(docs)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
