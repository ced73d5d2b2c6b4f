"""From raw documents to training tokens: five stages, each one operator applied to what its
predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to the
shared folder and read again as the next stage's ``docs``. All but the last return the columns of
``documents``. Rows with a null or empty text pass every filter; rows with a null id are judged by
their text where that is possible and kept otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.bpe import encode_documents
from rillstone.llm.common import read, stored
from rillstone.llm.decontaminate import verbatim_matches
from rillstone.llm.jaccard import jaccard_groups
from rillstone.llm.ordinal import graded, train
from rillstone.llm.substrings import dedup_substrings


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. The classifier learns from the rated ones among all documents."""
    model = train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "quality")
    return graded(docs, model).where("accepted OR row.text IS NULL OR row.text = ''").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, Jaccard of 0.8 or more) the document
    with the smallest id stays. Repeated rows of one id are no group: all of them stay."""
    groups = jaccard_groups(docs.select("doc_id", "text"), size=5, percent=80)
    spare = groups.where("component_id <> doc_id").select("doc_id")
    return docs.join(spare, "doc_id", "left_anti").select(*docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut. A text that loses words becomes its other words joined by one
    space, and n_chars their length; other texts stay as they are."""
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    found = dedup_substrings(docs, carry=rest)
    made = {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in rest:
        made["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("kept").cast("long")).otherwise(F.col("carried.n_chars"))
    return found.select(*(made.get(c, F.col(f"carried.{c}")).alias(c) for c in docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return verbatim_matches(docs, read(spark, sf_dir, "benchmark")).where("n_hit = 0").select("row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number and hashes."""
    return encode_documents(docs.select("doc_id", "text")).drop("decoded")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontaminated", decontaminated),
    ("encoded", encoded),
]

#: The quality stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
