"""Tenant-scoped access: rows of one tenant only, or none."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UUID = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\Z", re.I)


class TenantContext:
    """Access to tenant tables for one tenant; without a tenant all of them are empty. A tenant id that is no UUID is refused."""

    def __init__(self, tenant_id: str | None) -> None:
        if tenant_id is not None and not _UUID.match(tenant_id):
            raise ValueError("tenant id is no UUID")
        self.tenant_id = tenant_id

    def rows(self, table: DataFrame) -> DataFrame:
        return table.where(F.col("tenant_id") == self.tenant_id if self.tenant_id else F.lit(False))

    def append(self, rows: DataFrame, path: str) -> None:
        """Appends rows after checking that all of them are the tenant's own."""
        if self.tenant_id is None or rows.where(~F.col("tenant_id").eqNullSafe(F.lit(self.tenant_id))).limit(1).count():
            raise PermissionError("rows of another tenant")
        rows.write.mode("append").parquet(path)


def audit_projection(log: DataFrame) -> DataFrame:
    """id, tenant_id, computed_hash, matches: the hash of each query's text against the stored one; rows delivered twice count once."""
    own = F.sha2(F.col("query_text"), 256)
    return log.dropDuplicates(["id"]).select("id", "tenant_id", own.alias("computed_hash"), F.coalesce(own == F.col("query_hash"), F.lit(False)).alias("matches"))


def hashed_responses(log: DataFrame) -> DataFrame:
    """id, response_hash of what each logged query gave, worked out from its ids; rows delivered twice count once."""
    response = F.to_json(F.coalesce("retrieved_chunk_ids", F.array().cast("array<string>")))
    return log.select("id", F.sha2(response, 256).alias("response_hash")).groupBy("id").agg(F.min("response_hash").alias("response_hash"))


def tenant_usage(log: DataFrame) -> DataFrame:
    """tenant_id, queries, users, texts, mean_latency of each tenant. Partial sums before the shuffle carry the busiest tenant."""
    rows = log.groupBy("id").agg(*(F.first(c).alias(c) for c in ("tenant_id", "user_id", "query_hash", "latency_ms")))
    return rows.groupBy("tenant_id").agg(F.count("*").alias("queries"), F.countDistinct("user_id").alias("users"), F.countDistinct("query_hash").alias("texts"), F.round(F.avg("latency_ms"), 4).alias("mean_latency"))


def tenant_sources(log: DataFrame, chunks: DataFrame, articles: DataFrame, documents: DataFrame) -> DataFrame:
    """Distinct (tenant_id, source_id): the sources whose chunks a tenant was shown."""
    shown = log.select("tenant_id", F.explode("retrieved_chunk_ids").alias("chunk_id")).where("tenant_id IS NOT NULL").distinct()
    of = chunks.select(F.col("id").alias("chunk_id"), "article_id").join(articles.select(F.col("id").alias("article_id"), "document_id").dropDuplicates(["article_id"]), "article_id")
    of = of.join(documents.select(F.col("id").alias("document_id"), "source_id"), "document_id").select("chunk_id", "source_id")
    return shown.join(of, "chunk_id").select("tenant_id", "source_id").distinct()


def watch_fanout(changes: DataFrame, documents: DataFrame, interests: DataFrame) -> DataFrame:
    """document_id, source_id, tenant_id of a notice to each interested tenant; changed versions nobody follows keep a row with a null tenant.

    changes: document_id of changed versions; interests: tenant_id, source_id.
    """
    changed = changes.select("document_id").distinct().join(documents.select(F.col("id").alias("document_id"), "source_id"), "document_id")
    return changed.join(interests, "source_id", "left").select("document_id", "source_id", "tenant_id")
