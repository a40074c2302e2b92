"""Ingestion of delivered files as one batch over all sources, made visible by a commit marker."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qanat.functions.text import has_web_phrase, is_arabic, normalize_arabic
from qanat.operators.corpus import chunk_articles, citation_edges


def stable_id(*keys: Column) -> Column:
    """An id made from natural keys, the same at every recomputation."""
    h = F.md5(F.concat_ws("\x1f", *keys))
    return F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def validated(files: DataFrame) -> DataFrame:
    """files with `reason`: ok, invalid json, no articles, no text or website content; only the first article is looked at."""
    first = F.try_element_at("articles", F.lit(1))["text"]
    reason = F.when(F.col("articles").isNull(), "invalid json").when(F.size("articles") == 0, "no articles").when(F.coalesce(first, F.lit("")) == "", "no text").when(has_web_phrase(first), "website content").otherwise("ok")
    return files.withColumn("reason", reason)


def ingest(files: DataFrame, known: DataFrame) -> dict[str, DataFrame]:
    """documents, articles, chunks, edges of files not seen before, and rejected: source_name, reason.

    files: source_name, content_hash, articles. known: source_name, version_order, content_hash of earlier documents. A hash that any earlier
    version of the source had is unchanged and gives nothing. One source's failure leaves the others alone.
    """
    checked = validated(files)
    fresh = checked.where("reason = 'ok'").join(known.select("source_name", "content_hash"), ["source_name", "content_hash"], "left_anti")
    last = known.groupBy("source_name").agg(F.max("version_order").alias("last"))
    order = F.coalesce("last", F.lit(0)) + F.row_number().over(Window.partitionBy("source_name").orderBy("content_hash"))
    versioned = fresh.join(last, "source_name", "left").withColumn("version_order", order.cast("int"))
    documents = versioned.select(stable_id(F.col("source_name"), F.col("version_order").cast("string")).alias("id"), "source_name", "version_order", F.concat(F.lit("v"), F.col("version_order").cast("string")).alias("version"), "content_hash", F.size("articles").alias("article_count"), "articles")
    rows = documents.select(F.col("id").alias("document_id"), F.posexplode("articles").alias("at", "a"))
    arabic = is_arabic(F.col("a.text"), F.col("a.language"))
    articles = rows.select(
        stable_id(F.col("document_id"), F.col("at").cast("string")).alias("id"), "document_id", F.col("a.article_number").alias("article_number"), (F.col("at") + 1).alias("ordering"),
        F.when(arabic, F.col("a.text")).otherwise("").alias("text_ar"), F.when(arabic, "").otherwise(F.col("a.text")).alias("text_en"), F.when(arabic, normalize_arabic(F.col("a.text"))).otherwise("").alias("text_ar_normalized"),
    )
    chunks = chunk_articles(articles).withColumn("id", stable_id(F.col("article_id"), F.col("chunk_index").cast("string")))
    return {"documents": documents.drop("articles"), "articles": articles, "chunks": chunks, "edges": citation_edges(articles), "rejected": checked.where("reason != 'ok'").select("source_name", "reason")}


def write_run(tables: dict[str, DataFrame], path: str, run_id: str | None = None) -> str:
    """Writes the tables below a folder of the run, then a commit row that makes them visible. Gives the run's id."""
    run_id = run_id or uuid.uuid4().hex
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}/run={run_id}")
    spark = next(iter(tables.values())).sparkSession
    spark.createDataFrame([(run_id,)], "run_id string").coalesce(1).write.mode("append").parquet(f"{path}/_commits")
    return run_id


def committed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table's rows of committed runs."""
    runs = spark.read.parquet(f"{path}/_commits").select(F.col("run_id").alias("run")).distinct()
    return spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}").join(F.broadcast(runs) if runs.count() < 100_000 else runs, "run", "left_semi").drop("run")
