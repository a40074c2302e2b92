"""Changes of stored tables, expressed as new tables or appended events."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qanat.operators.ingest import stable_id

from qanat.operators.versions import latest_documents


def without_keys(held: DataFrame, doomed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the doomed ones; rows with a null key stay."""
    return held.join(doomed.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def replaced(held: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The held rows with all rows of the new rows' keys taken out and the new rows put in."""
    return without_keys(held, new, key).select(held.columns).unionByName(new.select(held.columns))


def latest_events(events: DataFrame, key: str, order: str) -> DataFrame:
    """The newest event of each key: an updated state is an appended event, never a changed row."""
    rest = [c for c in events.columns if c != key]
    return events.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_e")).select(key, *(F.col(f"_e.{c}").alias(c) for c in rest))


def fresh_questions(questions: DataFrame, articles: DataFrame, documents: DataFrame) -> DataFrame:
    """Questions without those whose first citation is an article of a version that is not its source's latest. Each id once."""
    rows = questions.dropDuplicates(["id"]).withColumn("article_id", F.get("expected_citations", F.lit(0)))
    of = articles.select(F.col("id").alias("article_id"), "document_id").dropDuplicates(["article_id"])
    old = of.join(latest_documents(documents).select("document_id"), "document_id", "left_anti").select("article_id")
    return without_keys(rows, old, "article_id").select(questions.columns)


def write_json(rows: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON object a line; null fields are left out."""
    rows.write.mode(mode).json(path)


def cloned(rows: DataFrame, key: str, n: int, prefix: str = "clone_") -> DataFrame:
    """The rows n times, with the copy's number in the key: a corpus for load tests."""
    copies = rows.sparkSession.range(n).select(F.col("id").alias("_copy"))
    return rows.crossJoin(F.broadcast(copies)).withColumn(key, F.concat(F.lit(prefix), F.col("_copy").cast("string"), F.lit("_"), F.col(key))).drop("_copy")


#: Tables that rows are only ever appended to: the columns that a new row names, those that default to an empty array, and those its id is made of.
APPENDED = {
    "source_snapshots": ("source_id string, content_hash string, raw_content string, fetched_at timestamp", (), ("source_id", "content_hash", "fetched_at")),
    "document_diffs": ("previous_document_id string, current_document_id string, added array<string>, updated array<string>, removed array<string>", ("added", "updated", "removed"), ("previous_document_id", "current_document_id")),
    "eval_questions": ("version string, domain string, question_ar string, question_en string, expected_citations array<string>, accepted_answer_ranges array<string>, attorney_rubric string, graded_by string", ("expected_citations", "accepted_answer_ranges"), ("version", "domain", "question_ar", "question_en")),
    "eval_runs": ("version string, model string, citation_recall double, citation_precision double, overall_score double, results string", (), ("version", "model", "results")),
}


def new_rows(rows: DataFrame, name: str) -> DataFrame:
    """Rows as the table `name` holds them: an id made of their keys, its columns, empty arrays for missing ones, and the time of now."""
    schema, arrays, keys = APPENDED[name]
    fields = [f.split(" ") for f in schema.split(", ")]
    held = [(F.col(c) if c in rows.columns else F.lit(None)).cast(t) for c, t in fields]
    filled = [F.coalesce(c, F.array().cast(t)).alias(n) if n in arrays else c.alias(n) for c, (n, t) in zip(held, fields)]
    return rows.select(*filled).select(stable_id(*(F.coalesce(F.col(k).cast("string"), F.lit("\x1e")) for k in keys)).alias("id"), "*", F.current_timestamp().alias("created_at"))


def append_rows(rows: DataFrame, name: str, path: str) -> None:
    """Appends rows to the table `name` below path."""
    new_rows(rows, name).write.mode("append").parquet(f"{path}/{name}")


def unseeded(rows: DataFrame, held: DataFrame, keys: tuple[str, ...] = ("version", "domain")) -> DataFrame:
    """Rows for whose keys nothing is held yet."""
    return rows.join(held.select(*keys).distinct(), list(keys), "left_anti").select(rows.columns)


def get_or_create(spark: SparkSession, path: str, name: str, residency: str = "standard") -> str:
    """The id of the tenant of that name below path; one is appended where there is none. Its id is made of the name, so a race makes no second."""
    new = spark.createDataFrame([(name, residency)], "name string, data_residency string").select(stable_id(F.col("name")).alias("id"), "name", "data_residency", F.current_timestamp().alias("created_at"))
    try:
        held = spark.read.parquet(path).where(F.col("name") == name).agg(F.min("id").alias("id")).first()["id"]
    except AnalysisException:
        held = None
    if held is None:
        new.write.mode("append").parquet(path)
        held = new.first()["id"]
    return held


def throughput(rows: int, seconds: float) -> float:
    """Rows a second; 0 where no time has passed."""
    return rows / seconds if seconds > 0 else 0.0
