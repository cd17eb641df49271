"""Corpus pipeline: five stages over ``documents``, each written as Parquet to
the shared checkpoint folder and reread as the next one's input.

1. toxicity: documents that the classifier chain rejects go.
2. near_duplicates: one document of each SimHash group stays, the smallest id.
3. secrets: spans found by the secret scan are masked in the text.
4. mixing: each row is repeated as often as the curriculum mix takes it, the
   copies in the order of their training positions.
5. packing: the texts are tokenised and packed into sequences.

Edge cases: rows without a doc_id take part; of a group without any id one row
stays. Rows that repeat a doc_id count as one document for deduplication. An
empty table runs through and gives an empty result. Columns beyond those of
``documents`` are carried along up to the last stage. The table of a stage is
deleted when the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm import catalog, mixing, packing, secret_scan, simhash, textio, toxicity
from tillwise.session import cut_lineage, delete_folder, forget_at_exit, new_folder, prepare

MAX_BROADCAST = 200_000  # ids; longer lists are joined by shuffle


def _sized(ids: DataFrame) -> DataFrame:
    """Written once; a broadcast hint only if it is small."""
    ids = cut_lineage(ids)
    return F.broadcast(ids) if ids.count() <= MAX_BROADCAST else ids


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    textio.bounded_batches(prepare(spark))
    chain = toxicity.fit(docs, textio.read_table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, chain)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = cut_lineage(simhash.near_duplicates(docs))
    if found.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").isEmpty():
        return docs.join(_sized(found.filter("doc_id <> component_id").select("doc_id")), "doc_id", "left_anti").select(*docs.columns)
    # ids that are missing or repeat don't tell rows apart: the first row of each group stays
    fp, root, no = (next(n for n in (f"__{name}{i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns) for name in ("fp", "root", "no"))
    tagged = cut_lineage(simhash.tagged(docs, fp))
    of = simhash.classes(tagged.select("doc_id", F.col(fp).alias("fp")))
    first = Window.partitionBy(root).orderBy(F.col("doc_id").asc_nulls_last(), "text")
    return (tagged.join(of.select(F.col("fp").alias(fp), F.col("root").alias(root)), fp).withColumn(no, F.row_number().over(first))
                  .filter(F.col(no) == 1).select(*docs.columns))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = secret_scan.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, catalog.tokenizer_path())


STAGES = [("toxicity", toxic), ("near_duplicates", near_duplicates), ("secrets", mask_secrets), ("mixing", mix_sources), ("packing", pack)]

ORACLE_SQL = None  # classifier, SimHash graph and packing are beyond SQL; the tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    textio.bounded_batches(prepare(spark))
    docs = textio.read_table(spark, sf_dir, "documents")
    written: list[str] = []
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        forget_at_exit(spark, path)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        written.append(path)
        for old in written[:-1]:       # this stage is written: nothing reads the one before any more
            delete_folder(spark, old)
        del written[:-1]
    return docs
