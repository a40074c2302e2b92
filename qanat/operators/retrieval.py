"""Retrieval: dense and sparse pools, their fusion, and the best chunk of each article."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qanat.functions.rank import text_match, text_rank
from qanat.functions.text import normalize_arabic
from qanat.functions.vector import dense_score, usable

POOL, TOP, DECIMALS, QUERY_BLOCK = 40, 5, 6, 4096


def current_documents(documents: DataFrame) -> DataFrame:
    """Versions that nothing supersedes."""
    return documents.where(F.col("superseded_by").isNull())


def current_articles(articles: DataFrame, documents: DataFrame) -> DataFrame:
    """article_id, document_id, article_number, source_id of the articles of current versions. Articles delivered twice count once."""
    first = F.min(F.struct("document_id", "article_number"))
    a = articles.groupBy(F.col("id").alias("article_id")).agg(first.alias("a")).select("article_id", "a.*")
    return a.join(current_documents(documents).select(F.col("id").alias("document_id"), "source_id"), "document_id")


def current_chunks(chunks: DataFrame, articles: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunks of current versions with their article's and document's keys."""
    return chunks.join(current_articles(articles, documents), "article_id")


def distances(chunks: DataFrame, vector: list[float]) -> DataFrame:
    """id, article_id, distance (rounded) of every chunk with a usable vector of the asked one's length, worked out where the chunk is read."""
    asked = np.array(vector, np.float64)
    size = float(np.linalg.norm(asked)) if len(asked) else 0.0
    schema = "id string, article_id string, distance double"
    if not size:
        return chunks.sparkSession.createDataFrame([], schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch["embedding_ar"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), -1)
            distance = np.round(1 - own @ asked / (np.linalg.norm(own, axis=1) * size), DECIMALS) + 0.0 if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["article_id"], pa.array(distance)], ["id", "article_id", "distance"])

    usable_rows = chunks.where(usable(F.col("embedding_ar")) & (F.size("embedding_ar") == len(asked)))
    return usable_rows.select("id", "article_id", "embedding_ar").mapInArrow(scan, schema)


def dense_pool(chunks: DataFrame, vector: list[float], k: int = POOL, current: DataFrame | None = None) -> DataFrame:
    """The k chunks (of current articles, where given) nearest to a vector: id, article_id, distance; ties go to the smaller id. Only distances are joined."""
    near = distances(chunks, vector)
    near = near if current is None else near.join(current.select("article_id"), "article_id", "left_semi")
    return near.orderBy("distance", "id").limit(k).select("id", "article_id", "distance")


def sparse_pool(chunks: DataFrame, hits: DataFrame, k: int = POOL, current: DataFrame | None = None) -> DataFrame:
    """The k chunks (of current articles, where given) that hold all terms, best rank first: id, article_id, sparse_score. hits: article_id, sparse_score."""
    found = hits if current is None else hits.join(current.select("article_id"), "article_id", "left_semi")
    return chunks.select("id", "article_id").join(found, "article_id").orderBy(F.desc("sparse_score"), "id").limit(k).select("id", "article_id", "sparse_score")


def fuse(dense: DataFrame, sparse: DataFrame) -> DataFrame:
    """Both pools in one: id, article_id, score; what one pool lacks counts 0."""
    d = dense.select("id", F.col("article_id").alias("da"), dense_score(F.col("distance")).alias("ds"))
    s = sparse.select("id", F.col("article_id").alias("sa"), F.col("sparse_score").alias("ss"))
    return d.join(s, "id", "full_outer").select("id", F.coalesce("da", "sa").alias("article_id"), F.round(F.coalesce("ds", F.lit(0.0)) + F.coalesce("ss", F.lit(0.0)), DECIMALS).alias("score"))


def best_per_group(rows: DataFrame, group: str | list[str], *order: Column) -> DataFrame:
    """The first row of each group in the given order."""
    return rows.withColumn("_place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where("_place = 1").drop("_place")


def hybrid_search(chunks: DataFrame, current: DataFrame, hits: DataFrame, vector: list[float], k: int = TOP, pool: int = POOL) -> DataFrame:
    """The k best articles, each by its best chunk: id, article_id, score. The pools hold chunks, so fewer than k articles may come out."""
    fused = fuse(dense_pool(chunks, vector, pool, current), sparse_pool(chunks, hits, pool, current))
    return best_per_group(fused, "article_id", F.desc("score"), F.col("id")).orderBy(F.desc("score"), "id").limit(k)


def decorated(found: DataFrame, chunks: DataFrame, current: DataFrame, sources: DataFrame) -> DataFrame:
    """Search results (a bounded top-k) with what a reader is shown: id, article_number, source_code, chunk_text, score."""
    rows = chunks.select("id", "chunk_text").join(F.broadcast(found), "id")
    rows = current.select("article_id", "article_number", "source_id").join(F.broadcast(rows), "article_id")
    return rows.join(sources.select(F.col("id").alias("source_id"), F.col("code").alias("source_code")), "source_id").select("id", "article_number", "source_code", "chunk_text", "score").orderBy(F.desc("score"), "id")


def search_audit(found: DataFrame, tenant_id: str, query: str, model: str, latency_ms: int | None = None, user_id: str | None = None) -> DataFrame:
    """The audit row of one search: hashes of the query and of the ids it gave, in their order, and the ids themselves."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))), lambda x: x["id"])
    row = found.agg(ids.alias("retrieved_chunk_ids"))
    response = F.to_json("retrieved_chunk_ids")
    fixed = {"tenant_id": tenant_id, "user_id": user_id, "query_text": query, "model_used": model, "citation_verifier_status": "pass"}
    return row.select(*(F.lit(v).cast("string").alias(n) for n, v in fixed.items()), F.sha2(F.lit(query), 256).alias("query_hash"), F.sha2(response, 256).alias("response_hash"), "retrieved_chunk_ids", F.lit(latency_ms).cast("int").alias("latency_ms"), F.current_timestamp().alias("created_at"))


def term_hits(articles: DataFrame, terms: list[str]) -> DataFrame:
    """article_id, sparse_score of the articles whose normalised Arabic text holds all terms. Texts are matched where they are read; only hits travel."""
    own = F.regexp_extract_all(F.lower(normalize_arabic(F.col("text_ar"))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    rows = articles.select(F.col("id").alias("article_id"), own.alias("words")).where(text_match(F.col("words"), terms))
    return rows.select("article_id", F.round(text_rank(F.col("words"), terms), DECIMALS).alias("sparse_score")).groupBy("article_id").agg(F.max("sparse_score").alias("sparse_score"))


def dense_pools(chunks: DataFrame, queries: DataFrame, k: int = POOL) -> DataFrame:
    """The k nearest chunks of every query, exactly: query_id, id, article_id, distance. queries: query_id, vector.

    Vectors without a value other than zero take no part; a query meets the vectors of its own length.
    Queries go in blocks of QUERY_BLOCK against all chunks; each task keeps k a query, then the blocks' tasks are merged.
    """
    spark = chunks.sparkSession
    asked = queries.where(usable(F.col("vector"))).select("query_id", "vector")
    lengths = {r["size"]: r["count"] for r in asked.groupBy(F.size("vector").alias("size")).count().collect()}
    out = None
    for length, block, blocks in [(size, b, n) for size in sorted(lengths or [0]) for n in [max(1, -(-lengths.get(size, 0) // QUERY_BLOCK))] for b in range(n)]:
        scanned = chunks.where(usable(F.col("embedding_ar")) & (F.size("embedding_ar") == length)).select("id", "article_id", "embedding_ar")
        own = asked.where((F.size("vector") == length) & (F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)).toPandas()
        matrix = np.array(own["vector"].tolist(), np.float64).reshape(len(own), -1)
        held = spark.sparkContext.broadcast((own["query_id"].tolist(), matrix / np.linalg.norm(matrix, axis=1, keepdims=True) if len(own) else matrix))

        def scan(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            names, asked = held.value
            for batch in batches:
                if not len(batch) or not names:
                    continue
                rows = batch["embedding_ar"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), -1)
                distance = np.round(1 - asked @ (rows / np.linalg.norm(rows, axis=1, keepdims=True)).T, DECIMALS) + 0.0  # no negative zero
                kth = np.partition(distance, min(k, len(batch)) - 1, axis=1)[:, min(k, len(batch)) - 1]
                q, at = np.nonzero(distance <= kth[:, None])
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in q]), batch["id"].take(take), batch["article_id"].take(take), pa.array(distance[q, at])], ["query_id", "id", "article_id", "distance"])

        found = scanned.mapInArrow(scan, "query_id string, id string, article_id string, distance double")
        out = found if out is None else out.unionByName(found)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return out.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")
