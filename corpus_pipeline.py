"""From raw documents to packed training sequences, as stages from DataFrame to DataFrame.

Each stage reads what the one before kept (a stored table, read again) and all
but the last return the columns of the documents.  Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelight.llm import common, mixing, near_duplicates, packing, secret_scan, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject at the threshold of their language."""
    common.prepared(spark)
    model = toxicity.train_toxicity(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies, the one with the smallest id."""
    common.prepared(spark)
    return near_duplicates.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by the name of its kind and ``n_chars`` counted anew where one was."""
    common.prepared(spark)
    inner, named = common.set_apart(docs)
    found = (
        secret_scan.scan_secrets(inner.select("__at", named["text"]), ("__at",))
        .where(F.size("spans") > 0)
        .select(F.col("__at").alias("__of"), "spans")
    )
    clean = F.when(F.col("spans").isNotNull(), secret_scan.redacted(named["text"], F.col("spans"))).otherwise(named["text"])
    told = inner.join(found, F.col("__at") == F.col("__of"), "left").withColumn("__clean", clean)
    changed = {"text": F.col("__clean").alias("text")}
    if "n_chars" in named:
        counted = F.when(F.col("spans").isNotNull(), F.length("__clean").cast("bigint")).otherwise(named["n_chars"])
        changed["n_chars"] = counted.alias("n_chars")
    return told.select(*[changed.get(c, named[c]) for c in docs.columns])


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the mix takes them; the one that is taken in part stays if that is half of it or more."""
    common.prepared(spark)
    inner, named = common.set_apart(docs)
    taken = (
        mixing.mix_sources(inner.select(named["doc_id"], named["text"], named["source"], "__at"), keep=("__at",))
        .where("size > 0")
        .select(F.col("__at").alias("__of"), F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("__times"))
        .where("__times > 0")
    )
    return (
        inner.join(taken, F.col("__at") == F.col("__of"))
        .withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__times"))))
        .select(*named.values())
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every row with the sequence and place that each got."""
    common.prepared(spark)
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_to_weights),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # trained, hashed and evolved results; tests/llm compares stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a folder; each stage is stored in the shared folder."""
    from parcelight.session import shared_path

    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
