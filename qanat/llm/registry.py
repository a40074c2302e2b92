"""Queries of this subpackage and the SQL they are held against, for __spark_entry__.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qanat.llm.languages import language_segments, record_languages
from qanat.llm.leakage import leaks, literal_leaks, measured_recall as leak_recall
from qanat.llm.lookalikes import consistent_texts, lookalike_classes, lookalike_pairs
from qanat.llm.neighbours import measured_recall, nearest
from qanat.llm.packing import pack
from qanat.llm.scans import repaired, scan_noise
from qanat.llm.sentences import sentence_units
from qanat.llm.splitting import corpus_records, oversized_pieces
from qanat.sources.tables import table


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "article_chunks").select("id", F.col("embedding_ar").alias("vector"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_vectors(spark, sf_dir)).select(F.col("id_a").alias("chunk_id_a"), F.col("id_b").alias("chunk_id_b"))


def p2_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index's recall against brute force, for one row in 50 against all rows."""
    rows = _vectors(spark, sf_dir)
    return measured_recall(rows, nearest(rows))


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oversized_pieces(corpus_records(table(spark, sf_dir, "articles"), table(spark, sf_dir, "article_chunks")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir).where("piece_index = 1").select("record_table", "record_id").distinct()


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of rows delivered twice with different texts the first text in order counts, so pieces never mix."""
    own = F.min(F.struct(F.md5("piece_text").alias("order"), "delivery")).over(Window.partitionBy("record_table", "record_id"))
    pieces = _pieces(spark, sf_dir).withColumn("own", own.getField("delivery")).where("delivery = own").drop("own", "delivery")
    return pieces.dropDuplicates(["record_table", "record_id", "piece_index"])


def p3_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pieces must be: records cut, pieces over the limit, wrong overlaps, pieces that do not begin or end where they must."""
    pieces = p3_pieces(spark, sf_dir)
    at = Window.partitionBy("record_table", "record_id").orderBy("piece_index")
    before = F.lag(F.col("first_token") + F.col("n_tokens")).over(at)
    flags = pieces.select("record_table", "record_id", (F.col("n_tokens") > 512).alias("over"), (before - F.col("first_token") != 50).alias("lap"), ((F.col("piece_index") == 1) & (F.col("first_token") != 0)).alias("start"), "piece_index", "pieces")
    return flags.agg(F.countDistinct("record_table", "record_id").alias("records"), F.count_if("over").alias("over"), F.count_if("lap").alias("wrong_overlaps"), F.count_if("start").alias("wrong_starts"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike_pairs(table(spark, sf_dir, "articles"))


def p7_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The look-alikes by class: a row for each article."""
    return lookalike_classes(table(spark, sf_dir, "articles"))


def p7_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """text_ar and the normalised text of every article in one consistent form."""
    articles = table(spark, sf_dir, "articles")
    kinds = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in ("text_ar", "text_ar_normalized"))))
    return consistent_texts(articles.select(F.col("id").alias("article_id"), kinds.alias("k")).select("article_id", "k.field", "k.text"))


def p8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a packing must be: items, items missing or cut though they fit, containers over the capacity, and the filled share in whole per cent."""
    packed = p8_packing(spark, sf_dir)
    bins = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("n"))
    items = packed.groupBy("item_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("parts"))
    a = items.agg(F.count("*").alias("items"), F.count_if((F.col("n") <= 4096) & (F.col("parts") > 1)).alias("cut"))
    b = bins.agg(F.count_if(F.col("n") > 4096).alias("over"), (F.sum("n") / F.count("*") / 4096 > 0.95).alias("well_filled"))
    return a.join(b)


def _bench(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    documents, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "bench_items")
    return documents.select(F.col("doc_id").alias("id"), "text"), items.select(F.col("item_id").alias("id"), "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return literal_leaks(*_bench(spark, sf_dir))


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All leaks with their evidence, paraphrase candidates too."""
    return leaks(*_bench(spark, sf_dir))


def p9_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many planted literal and reworded passages of every item are found among all documents."""
    return leak_recall(*_bench(spark, sf_dir))


def _scanned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    return tuple(table(spark, sf_dir, t) for t in ("misa", "articles", "law_documents"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_noise(*_scanned(spark, sf_dir))


def p4_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(*_scanned(spark, sf_dir))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_languages(table(spark, sf_dir, "misa"), table(spark, sf_dir, "documents")).where("NOT labelled").select("rec_id", "true_language")


def p5_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_segments(table(spark, sf_dir, "misa"), table(spark, sf_dir, "documents"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_units(_documents(spark, sf_dir), with_text=False).select("doc_id", "sentence_end")


def p10_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_units(_documents(spark, sf_dir))


QUERIES = {"p5_found": p5_found, "p5_segments": p5_segments, "p4_found": p4_found, "p4_repaired": p4_repaired, "p10_found": p10_found, "p10_sentences": p10_sentences, "p2_found": p2_found, "p2_recall": p2_recall, "p9_found": p9_found, "p9_report": p9_report, "p9_recall": p9_recall, "p3_found": p3_found, "p3_pieces": p3_pieces, "p3_check": p3_check, "p7_found": p7_found, "p7_classes": p7_classes, "p7_forms": p7_forms, "p8_packing": p8_packing, "p8_check": p8_check}

# The characters with the property White_Space, as a class for DuckDB's expressions.
_BLANK = "\\x{9}-\\x{D}\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"

# Exact where the table fits one leaf of the tree (LEAF_ROWS distinct vectors); beyond, p2_recall measures what is lost.
_P2 = """
WITH v AS (SELECT id, CAST(embedding_ar AS DOUBLE[]) AS e FROM article_chunks WHERE id IS NOT NULL AND list_max(list_transform(embedding_ar, lambda x: abs(x))) > 0),
s AS (SELECT a.id AS a, b.id AS b, round(list_cosine_similarity(a.e, b.e), 9) AS near FROM v a JOIN v b ON a.id <> b.id),
t AS (SELECT a, b FROM s QUALIFY row_number() OVER (PARTITION BY a ORDER BY near DESC, b) <= 5)
SELECT DISTINCT least(a, b) AS chunk_id_a, greatest(a, b) AS chunk_id_b FROM t
"""

_P3 = f"""
WITH r AS (SELECT record_table, record_id FROM (
  SELECT 'articles' AS record_table, id AS record_id, CASE WHEN text_ar <> '' THEN text_ar ELSE text_en END AS t FROM articles
  UNION ALL SELECT 'article_chunks', id, chunk_text FROM article_chunks)
WHERE len(regexp_extract_all(t, '[^{_BLANK}]+')) > 512)
"""

ORACLES = {
    "p2_found": _P2,
    "p3_found": _P3 + "SELECT record_table, record_id FROM r GROUP BY 1, 2",
    "p3_check": _P3 + "SELECT count(DISTINCT (record_table, record_id)) AS records, 0 AS over, 0 AS wrong_overlaps, 0 AS wrong_starts FROM r",
    "p8_check": "SELECT count(DISTINCT doc_id) AS items, 0 AS cut, 0 AS over, true AS well_filled FROM documents",
}
