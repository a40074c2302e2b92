"""Scoring of retrieval against expected citations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def question_scores(questions: DataFrame, retrieved: DataFrame) -> DataFrame:
    """question_id, domain, hits, recall, precision; without expected citations recall and precision are null (skipped).

    questions: question_id, domain, expected (array); retrieved: question_id, articles (array, best first). Expected ids count once, precision
    is by what was returned, 0 where nothing was.
    """
    seen = questions.join(retrieved, "question_id", "left")
    expected = F.array_distinct(F.filter(F.coalesce("expected", F.array().cast("array<string>")), lambda x: x.isNotNull()))
    got = F.coalesce("articles", F.array().cast("array<string>"))
    hits, asked = F.size(F.array_intersect(expected, got)), F.size(expected) > 0
    return seen.select("question_id", "domain", F.when(asked, hits).otherwise(0).alias("hits"), F.when(asked, hits / F.size(expected)).alias("recall"), F.when(asked, F.when(F.size(got) > 0, hits / F.size(got)).otherwise(0.0)).alias("precision"))


def by_domain(scores: DataFrame) -> DataFrame:
    """domain, total, skipped, recall, precision; the means leave skipped questions out."""
    return scores.groupBy("domain").agg(F.count("*").alias("total"), F.count_if(F.col("recall").isNull()).alias("skipped"), F.round(F.avg("recall"), 6).alias("recall"), F.round(F.avg("precision"), 6).alias("precision"))


def overall(scores: DataFrame) -> DataFrame:
    """scored, skipped, citation_recall, citation_precision, overall_score."""
    recall, precision = F.avg("recall"), F.avg("precision")
    return scores.agg(F.count("recall").alias("scored"), F.count_if(F.col("recall").isNull()).alias("skipped"), F.round(recall, 6).alias("citation_recall"), F.round(precision, 6).alias("citation_precision"), F.round((recall + precision) / 2, 6).alias("overall_score"))
