"""Operators over the article corpus: chunking, citations, checks, pairing, sampling, maintenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qanat.functions.text import chunk_windows, citations, first_words, has_web_phrase, is_arabic, normalize_arabic, words
from qanat.operators.versions import article_text, latest_documents


def chunk_articles(articles: DataFrame) -> DataFrame:
    """article_id, chunk_index (from 1), chunk_text, chunk_text_normalized, token_count of every article; articles without words give none."""
    text = article_text()
    windows = articles.dropDuplicates(["id"]).select(F.col("id").alias("article_id"), is_arabic(text).alias("arabic"), F.posexplode(chunk_windows(words(text))).alias("at", "window"))
    chunk = F.array_join("window", " ")
    return windows.select("article_id", (F.col("at") + 1).alias("chunk_index"), chunk.alias("chunk_text"), F.when(F.col("arabic"), normalize_arabic(chunk)).otherwise(chunk).alias("chunk_text_normalized"), F.size("window").alias("token_count"))


def article_citations(articles: DataFrame) -> DataFrame:
    """article_id, document_id, cited_number, matched_text of every ordinal citation in Arabic texts."""
    found = articles.dropDuplicates(["id"]).select(F.col("id").alias("article_id"), "document_id", F.explode(citations(F.col("text_ar"))).alias("c"))
    return found.select("article_id", "document_id", F.col("c.article_number").alias("cited_number"), F.col("c.matched_text").alias("matched_text"))


def citation_edges(articles: DataFrame) -> DataFrame:
    """from_article_id, to_article_id for citations that resolve to another article of the document; of equal numbers the first in order is meant."""
    target = articles.where("article_number IS NOT NULL").groupBy("document_id", F.col("article_number").alias("number")).agg(F.min_by("id", F.struct("ordering", "id")).alias("to_article_id"))
    cited = article_citations(articles).withColumn("number", F.col("cited_number").cast("string"))
    return cited.join(target, ["document_id", "number"]).where("article_id != to_article_id").select(F.col("article_id").alias("from_article_id"), "to_article_id", "matched_text")


def validate_documents(articles: DataFrame) -> DataFrame:
    """document_id, reason: ok, no text or website content, by the first article in order."""
    first = articles.where("document_id IS NOT NULL").groupBy("document_id").agg(F.min_by(article_text(), F.struct("ordering", "id")).alias("t"))
    reason = F.when(F.coalesce(F.col("t"), F.lit("")) == "", "no text").when(has_web_phrase(F.col("t")), "website content").otherwise("ok")
    return first.select("document_id", reason.alias("reason"))


def corpus_health(sources: DataFrame, documents: DataFrame, articles: DataFrame) -> DataFrame:
    """code, status, bad, total of each source's current version: no document, no articles, empty Arabic with English text, or ok."""
    current = documents.where("superseded_by IS NULL").groupBy("source_id").agg(F.min("id").alias("document_id"))
    flags = articles.dropDuplicates(["id"]).groupBy("document_id").agg(F.count("*").alias("total"), F.count_if((F.trim(F.coalesce("text_ar", F.lit(""))) == "") & (F.length(F.coalesce("text_en", F.lit(""))) > 50)).alias("bad"))
    seen = sources.select(F.col("id").alias("source_id"), "code").join(current, "source_id", "left").join(flags, "document_id", "left")
    status = F.when(F.col("document_id").isNull(), "no document").when(F.col("total").isNull(), "no articles").when(F.col("bad") > 0, "empty arabic").otherwise("ok")
    return seen.select("code", status.alias("status"), F.coalesce("bad", F.lit(0)).alias("bad"), F.coalesce("total", F.lit(0)).alias("total"))


def unpaired_numbers(articles: DataFrame) -> DataFrame:
    """document_id, number, missing: bilingual articles (ar_n, en_n) that lack the other language."""
    numbers = articles.where(F.col("article_number").rlike("^(ar|en)_")).select("document_id", F.substring("article_number", 1, 2).alias("language"), F.expr("substring(article_number, 4)").alias("number")).distinct()
    sides = numbers.groupBy("document_id", "number").agg(F.max(F.col("language") == "ar").alias("ar"), F.max(F.col("language") == "en").alias("en"))
    bilingual = numbers.groupBy("document_id").agg(F.countDistinct("language").alias("n")).where("n = 2").select("document_id")
    return sides.where("NOT (ar AND en)").join(bilingual, "document_id", "left_semi").select("document_id", "number", F.when(F.col("ar"), "en").otherwise("ar").alias("missing"))


def spread_sample(rows: DataFrame, group: str, order: list[str], k: int) -> DataFrame:
    """k rows of each group, evenly spaced and not at its ends: step max(1, n / (k + 1)), places i * step."""
    w = Window.partitionBy(group)
    placed = rows.withColumn("_at", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / (k + 1)))
    picks = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.least(i * step, F.col("_n") - 1)))
    return placed.where(F.array_contains(picks, F.col("_at").cast("long"))).drop("_at", "_n")


def first_picks(rows: DataFrame, group: str, order: list[str], k: int) -> DataFrame:
    """At most k rows of each group, evenly spaced from its first one: step max(1, n / k), places 0, step, ..."""
    w = Window.partitionBy(group)
    placed = rows.withColumn("_at", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / F.least(F.lit(k), F.col("_n"))))
    return placed.where((F.col("_at") % step == 0) & (F.col("_at") < step * k)).drop("_at", "_n")


def leading_articles(articles: DataFrame, documents: DataFrame, n: int) -> DataFrame:
    """source_id, id, ordering of the first n articles, in order, of each source's current versions."""
    current = documents.where("superseded_by IS NULL").select(F.col("id").alias("document_id"), "source_id")
    rows = articles.select("id", "document_id", "ordering").distinct().join(current, "document_id")
    place = F.row_number().over(Window.partitionBy("source_id").orderBy("ordering", "id"))
    return rows.withColumn("_at", place).where(F.col("_at") <= n).select("source_id", "id", "ordering")


def first_with_content(articles: DataFrame) -> DataFrame:
    """document_id, article_id, question: the first article of each version that says something: 20 characters, and over 20 in its first words."""
    text, opening = F.col("text_ar"), first_words(F.col("text_ar"))
    able = articles.where((F.length(text) >= 20) & (F.length(opening) > 20) & F.col("document_id").isNotNull())
    first = F.min_by(F.struct(F.col("id").alias("article_id"), opening.alias("question")), F.struct("ordering", "id"))
    return able.groupBy("document_id").agg(first.alias("f")).select("document_id", "f.*")


def seed_questions(articles: DataFrame, documents: DataFrame, questions: DataFrame, k: int = 3) -> DataFrame:
    """source_id, article_id, question: the first words of evenly spaced articles of the latest versions that have structure and no question yet."""
    cited = questions.select(F.explode("expected_citations").alias("article_id")).distinct()
    latest = latest_documents(documents).select("source_id", "document_id")
    body = F.when(F.instr("text_ar", ":") > 0, F.trim(F.expr("substring(text_ar, instr(text_ar, ':') + 1)")))
    able = articles.dropDuplicates(["id"]).select(F.col("id").alias("article_id"), "document_id", "ordering", body.alias("body")).where((F.size(words(F.col("body"))) >= 15))
    able = able.join(latest, "document_id").join(cited, "article_id", "left_anti")
    return spread_sample(able, "source_id", ["ordering", "article_id"], k).select("source_id", "article_id", first_words(F.col("body")).alias("question"))


def stale_citations(questions: DataFrame, articles: DataFrame, documents: DataFrame) -> DataFrame:
    """question_id, citation, state of every citation: latest, older version or does not exist."""
    of = articles.select(F.col("id").alias("citation"), "document_id").dropDuplicates(["citation"])
    latest = latest_documents(documents).select("document_id", F.lit(True).alias("latest"))
    cited = questions.select(F.col("id").alias("question_id"), F.explode("expected_citations").alias("citation")).where("citation IS NOT NULL").distinct()
    seen = cited.join(of, "citation", "left").join(latest, "document_id", "left")
    return seen.select("question_id", "citation", F.when(F.col("document_id").isNull(), "does not exist").when(F.col("latest"), "latest").otherwise("older version").alias("state"))


def cascade_counts(sources: DataFrame, documents: DataFrame, articles: DataFrame, chunks: DataFrame, prefix: str) -> DataFrame:
    """table, doomed rows, kept rows when all sources whose slug has the prefix are removed with everything below them."""
    gone = sources.where(F.col("slug").startswith(prefix)).select(F.col("id").alias("source_id"))
    docs = documents.select(F.col("id").alias("document_id"), "source_id").join(gone.withColumn("doomed", F.lit(1)), "source_id", "left")
    arts = articles.select(F.col("id").alias("article_id"), "document_id").dropDuplicates(["article_id"]).join(docs.select("document_id", "doomed"), "document_id", "left")
    parts = chunks.select("article_id").join(arts.select("article_id", "doomed"), "article_id", "left")
    named = [("sources", sources.select(F.when(F.col("slug").startswith(prefix), 1).alias("doomed"))), ("law_documents", docs), ("articles", arts), ("article_chunks", parts)]
    out = None
    for name, rows in named:
        one = rows.agg(F.lit(name).alias("table_name"), F.count("doomed").alias("doomed"), (F.count("*") - F.count("doomed")).alias("kept"))
        out = one if out is None else out.unionByName(one)
    return out


def cascade(sources: DataFrame, documents: DataFrame, articles: DataFrame, chunks: DataFrame, prefix: str) -> dict[str, DataFrame]:
    """The rows of each table that stay when all sources whose slug has the prefix are removed with everything below them, children first."""
    gone = sources.where(F.col("slug").startswith(prefix)).select(F.col("id").alias("source_id"))
    docs = documents.join(gone, "source_id", "left_semi").select(F.col("id").alias("document_id"))
    arts = articles.join(docs, "document_id", "left_semi").select(F.col("id").alias("article_id")).distinct()
    return {
        "article_chunks": chunks.join(arts, "article_id", "left_anti").select(chunks.columns),
        "articles": articles.join(docs, "document_id", "left_anti").select(articles.columns),
        "law_documents": documents.join(gone, "source_id", "left_anti").select(documents.columns),
        "sources": sources.where(~F.coalesce(F.col("slug").startswith(prefix), F.lit(False))),
    }


def upsert_sources(held: DataFrame, new: DataFrame) -> DataFrame:
    """Sources after an upsert on slug: code, type, issuer and updated_at of known ones change; jurisdiction and language_primary stay."""
    h, n = held.alias("h"), new.alias("n")
    both = h.join(n, F.col("h.slug") == F.col("n.slug"), "full_outer")
    taken = ("code", "type", "issuer", "updated_at")
    first = lambda c: (F.coalesce(f"n.{c}", f"h.{c}") if c in taken else F.coalesce(f"h.{c}", f"n.{c}")).alias(c)
    return both.select(*(first(c) for c in held.columns))


def trigrams(c: Column) -> Column:
    """The set of three-letter pieces of a padded, lower-case text."""
    padded = F.concat(F.lit("  "), F.lower(c), F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substr(padded, i, F.lit(3))))


def fuzzy_lookup(rows: DataFrame, column: str, wanted: str, least: float = 0.3) -> DataFrame:
    """Rows whose text is similar to the wanted one by the Jaccard index of their trigrams, as `similarity`."""
    own, asked = trigrams(F.col(column)), trigrams(F.lit(wanted))
    value = F.size(F.array_intersect(own, asked)) / F.size(F.array_union(own, asked))
    return rows.withColumn("similarity", F.round(value, 6)).where(F.col("similarity") >= least)
