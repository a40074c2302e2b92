"""Version chains, change detection and article diffs of versioned documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def version_chain(documents: DataFrame) -> DataFrame:
    """document_id, source_id, version_order, next_version (label of the version to come), successor (the next document), by created_at."""
    order = Window.partitionBy("source_id").orderBy("created_at", "id")
    place = F.row_number().over(order)
    return documents.select(F.col("id").alias("document_id"), "source_id", place.alias("version_order"), F.concat(F.lit("v"), (place + 1).cast("string")).alias("next_version"), F.lead("id").over(order).alias("successor"))


def latest_documents(documents: DataFrame) -> DataFrame:
    """The newest version of each source: source_id, document_id, version."""
    newest = F.max_by(F.struct("id", "version"), F.struct("created_at", "id"))
    return documents.groupBy("source_id").agg(newest.alias("d")).select("source_id", F.col("d.id").alias("document_id"), F.col("d.version").alias("version"))


def unchanged_documents(documents: DataFrame) -> DataFrame:
    """Deliveries whose content hash an earlier version of the source, any of them, already had: document_id, first_document_id."""
    order = Window.partitionBy("source_id", "source_hash").orderBy("created_at", "id")
    rows = documents.where("source_hash IS NOT NULL").select(F.col("id").alias("document_id"), F.first("id").over(order).alias("first_document_id"))
    return rows.where("document_id != first_document_id")


def article_text() -> Column:
    """The Arabic text, or the English one where that is null or empty."""
    return F.coalesce(F.when(F.col("text_ar") != "", F.col("text_ar")), F.col("text_en"))


def article_diff(articles: DataFrame, documents: DataFrame) -> DataFrame:
    """Articles of each version against the version delivered before: document_id, article_number, change (added, updated, removed).

    Numbers compare as written and null is one of them. Of equal numbers in a version the last one counts. A previous text that is null or ''
    makes an article added.
    """
    chain = version_chain(documents)
    text = F.max_by(F.md5(F.coalesce(article_text(), F.lit(""))), F.struct("ordering", "id"))
    state = articles.groupBy("document_id", "article_number").agg(text.alias("digest"))
    nothing = F.md5(F.lit(""))
    new = state.join(chain.where("version_order > 1").select("document_id"), "document_id").select("document_id", F.col("article_number").alias("number"), F.col("digest").alias("new"))
    old = state.join(chain.where("successor IS NOT NULL").select("document_id", "successor"), "document_id").select(F.col("successor").alias("document_id"), F.col("article_number").alias("number"), F.col("digest").alias("old"))
    both = new.withColumn("has_new", F.lit(True)).alias("n").join(old.withColumn("has_old", F.lit(True)).alias("o"), (F.col("n.document_id") == F.col("o.document_id")) & F.col("n.number").eqNullSafe(F.col("o.number")), "full_outer")
    change = F.when(F.col("has_new").isNull(), "removed").when(F.col("has_old").isNull() | (F.col("old") == nothing), "added").when(F.col("old") != F.col("new"), "updated")
    return both.select(F.coalesce("n.document_id", "o.document_id").alias("document_id"), F.coalesce("n.number", "o.number").alias("article_number"), change.alias("change")).where("change IS NOT NULL")


def diff_summary(diff: DataFrame) -> DataFrame:
    """document_id, added, updated, removed: sorted article numbers of each change."""
    numbers = lambda kind: F.array_sort(F.collect_list(F.when(F.col("change") == kind, F.coalesce("article_number", F.lit("")))))
    return diff.groupBy("document_id").agg(*(numbers(k).alias(k) for k in ("added", "updated", "removed")))
