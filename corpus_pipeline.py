"""Documents from raw to packed: every stage reads what the one before it kept.

All stages but the last return the columns of their documents. Columns travel
under plain names inside an operator, so no column of the documents can clash
with an operator's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.llm import decontaminate, packing, toxicity
from partflow.llm.common import table
from partflow.llm.near_dedup import near_duplicates
from partflow.llm.substring_dedup import remove_repeats
from partflow.llm.tokens import default_path
from partflow.session import materialize


#: Similarity from which documents are near duplicates here; op2's own contract is 85.
NEAR_PERCENT = 80


def _shielded(docs: DataFrame) -> tuple[DataFrame, str, list]:
    """``docs`` under plain names, the name of its text, and the columns back."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    back = [F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)]
    return plain, f"c{docs.columns.index('text')}", back


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.learn(docs.select("doc_id", "text"), labels)
    plain, text, back = _shielded(docs)
    return toxicity.score(plain, model, text).filter("predicted = 0").select(*back)


def near_duplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: the smallest id's first.

    Rows are compared one by one, under keys of their own that are written once.
    A row without an id only stays if no row of its group has one.
    """
    plain, text, back = _shielded(docs)
    rows = materialize(plain.withColumn("row", F.monotonically_increasing_id()), "near-rows")
    found = near_duplicates(rows, "row", text, percent=NEAR_PERCENT)
    groups = found.filter("not kept").select("component_id").distinct()
    linked = found.select("row", "component_id").join(groups, "component_id", "left_semi")
    linked = materialize(linked.join(rows.select("row", F.col(f"c{docs.columns.index('doc_id')}").alias("id")), "row"), "near-linked")
    order = F.struct(F.col("id").isNull().alias("bare"), F.col("id").alias("id"), F.col("row").alias("row"))
    first = linked.groupBy("component_id").agg(F.min(order).alias("first")).select("first.row")
    gone = materialize(linked.join(first, "row", "left_anti").select("row"), "near-gone")
    return rows.join(gone, "row", "left_anti").select(*back)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that recur are cut out; documents all stay, with their text's new length."""
    plain, text, _ = _shielded(docs)
    cleaned = remove_repeats(plain, text)
    cut = F.col("n_removed") > 0
    new = {"text": F.when(cut, F.col("kept_text")).otherwise(F.col(text))}
    if "n_chars" in docs.columns:
        old = F.col(f"c{docs.columns.index('n_chars')}")
        new["n_chars"] = F.when(cut, F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(old)
    return cleaned.select(*[new.get(name, F.col(f"c{i}")).alias(name) for i, name in enumerate(docs.columns)])


def contaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    plain, text, back = _shielded(docs)
    return decontaminate.mark_hits(plain, table(spark, sf_dir, "benchmark"), text=text).filter(F.size("_hits") == 0).select(*back)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in sequences of at most 1024."""
    pieces = packing.pack(docs, default_path("byte_bpe_50k.json"), end_id=0)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = (
    ("toxicity", toxic_documents),
    ("near_dedup", near_duplicate_documents),
    ("substring_dedup", repeated_passages),
    ("decontamination", contaminated_documents),
    ("packing", packed_sequences),
)
#: The rows of ``run`` cannot be expressed in SQL: it scores, tokenizes and packs.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
