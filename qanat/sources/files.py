"""Manifest and article files, and positioned text items of pages."""

from __future__ import annotations

import hashlib
import json
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ARTICLE = "array<struct<article_number: string, article_type: string, language: string, text: string, source_url: string, fetched_at: string, source_doc: string, global_index: int>>"
MANIFEST = "struct<generated_at: string, sources: array<struct<name: string, status: string, article_count: int, language: string, source_url: string, fetched_at: string>>>"


# Known sources as slug: (code, type, issuer).
REGISTRY = {
    "zatca_einvoicing_regulation": ("ZATCA_EINVOICING_REGULATION", "regulation", "Zakat, Tax and Customs Authority (ZATCA)"),
    "zatca_implementation_resolution": ("ZATCA_IMPLEMENTATION_RESOLUTION", "regulation", "Zakat, Tax and Customs Authority (ZATCA)"),
    "zatca_guidelines": ("ZATCA_GUIDELINES", "guidance", "Zakat, Tax and Customs Authority (ZATCA)"),
    "zatca_vat_agreement": ("ZATCA_VAT_AGREEMENT", "regulation", "Zakat, Tax and Customs Authority (ZATCA)"),
    "labor": ("LABOR_LAW", "statute", "Ministry of Human Resources and Social Development (HRSD)"),
    "companies": ("COMPANIES_LAW", "statute", "Ministry of Commerce"),
    "pdpl": ("PDPL", "statute", "Saudi Data & AI Authority (SDAIA)"),
    "sama": ("SAMA_CIRCULAR", "regulation", "Saudi Central Bank (SAMA)"),
    "cma": ("CMA_LAW", "statute", "Capital Market Authority (CMA)"),
    "nca": ("NCA_ECC", "regulation", "National Cybersecurity Authority (NCA)"),
    "misa": ("MISA_INVESTMENT_LAW", "statute", "Ministry of Investment (MISA)"),
}


def read_manifest(spark: SparkSession, path: str, source: str | None = None, status: str | None = None) -> DataFrame:
    """The sources of a manifest, all or the one of that name whatever its case, of any status or the given one; an unknown name gives none."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", MANIFEST)["sources"]).alias("s")).select("s.*")
    rows = rows if status is None else rows.where(F.col("status") == status)
    return rows if source is None else rows.where(F.upper("name") == source.upper())


@F.pandas_udf(StringType())
def canonical_hash(files: pd.Series) -> pd.Series:
    """SHA-256 of a JSON text written compactly in its own key order; null for what is no JSON. White space doesn't count."""

    def digest(text: str) -> str | None:
        try:
            return hashlib.sha256(json.dumps(json.loads(text), separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
        except (ValueError, TypeError):
            return None

    return files.map(digest)


def read_article_files(spark: SparkSession, *paths: str) -> DataFrame:
    """source_name, content_hash, articles (an array in file order; null where the file is no JSON array) of each file <source_name>.json."""
    rows = spark.read.text(list(paths), wholetext=True).select(F.regexp_extract("_metadata.file_name", r"([^/]*)\.json$", 1).alias("source_name"), "value")
    return rows.select("source_name", canonical_hash("value").alias("content_hash"), F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", ARTICLE)).alias("articles"))


def held_versions(files: DataFrame, documents: DataFrame) -> DataFrame:
    """Every stored version of each file's source with whether the file is that version: source_name, document_id, version, same.

    files: source_name, content_hash; documents: source_name, document_id, version, source_hash. A file whose source has no version gives one row
    without a document.
    """
    both = files.select("source_name", "content_hash").join(documents, "source_name", "left")
    return both.select("source_name", "document_id", "version", F.coalesce(F.col("source_hash") == F.col("content_hash"), F.lit(False)).alias("same"))


def page_lines(items: DataFrame) -> DataFrame:
    """page, line, text of positioned items (page, item_no, str, y, has_eol): a line ends at an item with has_eol, or where the rounded y is
    over 2 away from that of the line's first item. Pages are independent and bounded; items without text keep their place."""

    def lines(page: pd.DataFrame) -> pd.DataFrame:
        out, held, anchor = [], [], None
        for item in page.sort_values("item_no").itertuples():
            y = math.floor(item.y + 0.5)
            if anchor is not None and abs(y - anchor) > 2:
                out.append("".join(held))
                held, anchor = [], None
            anchor = y if anchor is None else anchor
            held.append(item.str or "")
            if item.has_eol:
                out.append("".join(held))
                held, anchor = [], None
        if held:
            out.append("".join(held))
        return pd.DataFrame({"page": page["page"].iloc[0], "line": range(1, len(out) + 1), "text": out})

    return items.groupBy("page").applyInPandas(lines, "page int, line int, text string")


def read_binary(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """path, length, content of binary files such as PDFs."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length", "content")


def parse_vector(c: Column) -> Column:
    """array<float> of a text like [1,2.5]; null for anything else."""
    return F.from_json(c, "array<float>")


def source_metadata(name: Column) -> Column:
    """struct<slug, code, type, issuer> of a source: as registered, or its own name in capitals, a regulation of an unknown issuer."""
    unknown = F.struct(name.alias("slug"), F.upper(name).alias("code"), F.lit("regulation").alias("type"), F.lit("Unknown").alias("issuer"))
    out = unknown
    for slug, values in REGISTRY.items():
        out = F.when(name == slug, F.struct(name.alias("slug"), *(F.lit(v).alias(k) for k, v in zip(("code", "type", "issuer"), values)))).otherwise(out)
    return out
