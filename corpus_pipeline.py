"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage is a function of (spark, docs, sf_dir) over all documents that the
one before kept; its result is written as Parquet and reread as the next one's
documents. All but the last return the columns of documents.

A verdict belongs to a row: rows are told apart by a hash of id, language and text.
Rows equal in all three get the same verdict, and one of them stays where copies go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import broadcast_if_small, stage, table
from tidewater.llm.fm_index import find_contamination
from tidewater.llm.kneser_ney import judge
from tidewater.llm.packing import pack_documents
from tidewater.llm.queries import VOCABULARY
from tidewater.llm.simhash import near_duplicates
from tidewater.llm.suffix_dedup import remove_repeats
from tidewater.llm.tokens import vocabulary_path


#: Column that tells rows apart while a stage runs.
KEY = "__row_key"


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a hash of all that a verdict depends on."""
    return docs.withColumn(KEY, F.xxhash64("doc_id", F.col("lang").isNull(), "lang", "text"))


def _without(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """``keyed`` without the rows whose key is in ``keys`` (column gone)."""
    small = broadcast_if_small(keys)
    return keyed.join(small, keyed[KEY] == small.gone, "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    keyed = _keyed(docs)
    verdict = judge(keyed, table(spark, sf_dir, "labels"), key=KEY)
    return _without(keyed, verdict.filter("NOT kept").select(F.col("key").alias("gone")).distinct()).drop(KEY)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays: the first by id (null last) and key."""
    keyed = _keyed(docs)
    found = stage(near_duplicates(keyed, words=3, budget=2, key=KEY), "near-duplicates")
    kept = _without(keyed, found.filter("NOT stays").select(F.col("key").alias("gone")).distinct())
    repeated = found.filter("stays").groupBy(F.col("key").alias("gone")).count().filter("count > 1").select("gone")
    if not repeated.limit(1).count():
        return kept.drop(KEY)
    # of equal rows one stays; a limit of one row works before the shuffle
    small = broadcast_if_small(repeated)
    one = Window.partitionBy(KEY).orderBy("text")
    several = kept.join(small, kept[KEY] == small.gone, "left_semi") \
        .select("*", F.row_number().over(one).alias("__row")).filter("__row = 1").drop("__row")
    return _without(kept, repeated).unionByName(several).drop(KEY)


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that also start earlier are cut out."""
    out = remove_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark passages go."""
    keyed = _keyed(docs)
    found = find_contamination(keyed.select(F.col(KEY).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = stage(found.filter("contaminated").select(F.col("doc_id").alias("gone")).distinct(), "contaminated")
    return _without(keyed, gone).drop(KEY)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of 2048 ids (end id 0)."""
    return pack_documents(docs, vocabulary_path(VOCABULARY), end_id=0, capacity=2048)


STAGES = [("quality", quality), ("near_duplicate", near_duplicate), ("repeated_text", repeated_text),
          ("decontaminate", decontaminate), ("packing", packing)]

#: SQL cannot express the stages; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), name)
    return docs
