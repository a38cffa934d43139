"""The corpus pipeline: stages over ``documents``, each written and read again before the next.

Every stage works on all rows its predecessor kept. Rows with a null ``doc_id`` go through unless a stage
rejects their text; of rows that repeat an id the near-duplicate stage keeps one. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatledger.llm import decontam, langid, linededup, packing, simhash
from heatledger.llm.common import materialise


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return langid.keep_identified(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document with a smaller id has."""
    out = linededup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)


def one_row_an_id(docs: DataFrame) -> DataFrame:
    """Of rows that repeat an id that with the smallest text (of equal ones the smallest of the other columns); rows without an id all stay."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    many = docs.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).count().filter("count > 1").select("_id")
    many = materialise(many, "repeated-ids")
    many = many.hint("shuffle_hash")  # ids grow with the table, so none go through the driver; texts are not sorted
    best = docs.join(many, docs["doc_id"] == many["_id"], "left_semi").groupBy("doc_id").agg(F.min(F.struct("text", *rest)).alias("r"))
    return docs.join(many, docs["doc_id"] == many["_id"], "left_anti").unionByName(best.select("doc_id", "r.*").select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that with the smallest id."""
    docs = one_row_an_id(docs)
    keep = simhash.near_duplicates(docs).filter("d = component_id")
    first = materialise(keep.select(F.col("d").alias("_sh_id")), "near-duplicate-firsts")
    return docs.join(first.hint("shuffle_hash"), docs["doc_id"] == first["_sh_id"], "left_semi").unionByName(docs.filter("doc_id IS NULL"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document lies in the packed sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL can express neither the classifier nor the packing.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
