"""References to records that do not exist.

Keys are range-partitioned on a 64-bit hash, so ranges are even whatever the keys look like. Each range keeps its parents as sorted arrays, and
batches of references probe them by binary search. The references of a range are counted first; a range that many of them point to (a hot key)
is cut into slices of bounded size, each with its own copy of the range's parents. Misses are aggregated afterwards.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qanat.functions.columns import key_form
from qanat.session import partitions

PARENTS_PER_RANGE, REFERENCES_PER_SLICE = 100_000, 100_000


def _probe(parents: pd.DataFrame, references: pd.DataFrame) -> pd.DataFrame:
    """parents: key, deleted, made; references: record_id, ref_key, at. Rows whose reference does not hold."""
    keys = parents["key"].to_numpy(object)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    wanted = references["ref_key"].to_numpy(object)
    at = np.searchsorted(keys, wanted)
    hit = at < len(keys)
    hit[hit] = keys[at[hit]] == wanted[hit]
    deleted, late = np.zeros(len(wanted), bool), np.zeros(len(wanted), bool)
    if hit.any():
        found = order[at[hit]]
        deleted[hit] = parents["deleted"].to_numpy(bool)[found]
        late[hit] = parents["made"].to_numpy()[found] > references["at"].to_numpy()[hit]  # NaN is never later
    kind = np.where(~hit, "missing", np.where(deleted, "deleted", np.where(late, "late", "")))
    out = references[["record_id", "ref_key"]].assign(orphan_kind=kind)
    return out[out["orphan_kind"] != ""]


def orphan_references(references: DataFrame, parents: DataFrame) -> DataFrame:
    """References that do not hold: record_id, ref_key, orphan_kind.

    references: record_id, ref_key, at (double seconds, or null where lateness does not count), once per record and key; null keys must be
    gone. parents: key, deleted (boolean), made (double seconds or null). A parent row given several times counts once: deleted only if every
    one is, made at the earliest. kinds: missing, else deleted, else late (the parent was made after `at`). No parents: all are missing.
    """
    spark = references.sparkSession
    n_parents = parents.count()
    ranges = max(partitions(spark), math.ceil(n_parents / PARENTS_PER_RANGE))
    range_of = lambda c: F.shiftright(F.xxhash64(c), 32) + F.lit(2**31)
    width = math.ceil(2**32 / ranges)
    bucket = lambda c: F.floor(range_of(c) / width).cast("int")
    refs = references.select("record_id", "ref_key", "at", bucket(F.col("ref_key")).alias("bucket"))
    cuts = refs.groupBy("bucket").count().select("bucket", F.ceil(F.col("count") / REFERENCES_PER_SLICE).cast("int").alias("slices"))  # one row a range
    refs = refs.join(F.broadcast(cuts), "bucket").withColumn("slice", F.pmod(F.xxhash64("record_id", "ref_key"), "slices").cast("int")).drop("slices")
    own = parents.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("deleted").alias("deleted"), F.min("made").alias("made"))
    own = own.withColumn("bucket", bucket(F.col("key"))).join(F.broadcast(cuts), "bucket").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    on = ["bucket", "slice"]
    probed = own.select("key", "deleted", "made", *on).groupBy(*on).cogroup(refs.groupBy(*on))
    return probed.applyInPandas(lambda p, r: _probe(p, r), "record_id string, ref_key string, orphan_kind string")


def seconds(c: Column) -> Column:
    """A timestamp as double seconds, microseconds kept."""
    return F.unix_micros(c) / 1e6


def corpus_orphans(law_documents: DataFrame, articles: DataFrame, questions: DataFrame) -> DataFrame:
    """Orphans of superseded_by (to law_documents) and expected_citations (to articles): record_table, record_id, ref_key, orphan_kind, made_at.

    made_at is the referring row's created_at, which dates it in reports. Rows delivered twice count once.
    """
    status = F.coalesce(F.col("metadata.status") == "deleted", F.lit(False))
    documents = law_documents.select(key_form(F.col("id")).alias("key"), status.alias("deleted"), F.lit(None).cast("double").alias("made"), "id")
    links = law_documents.select(F.col("id").alias("record_id"), key_form(F.col("superseded_by")).alias("ref_key")).dropna().distinct().withColumn("at", F.lit(None).cast("double"))
    own = articles.select(key_form(F.col("id")).alias("key"), "document_id", seconds(F.col("created_at")).alias("made"))
    of = documents.groupBy(F.col("id").alias("document_id")).agg(F.min("deleted").alias("deleted"))
    cited = own.join(of, "document_id", "left").select("key", F.coalesce("deleted", F.lit(False)).alias("deleted"), "made")
    asked = questions.groupBy(F.col("id").alias("record_id")).agg(F.min("created_at").alias("made_at"))
    citations = questions.select(F.col("id").alias("record_id"), F.explode("expected_citations").alias("c"), "created_at").select("record_id", key_form(F.col("c")).alias("ref_key"), seconds(F.col("created_at")).alias("at"))
    citations = citations.where(F.col("record_id").isNotNull() & F.col("ref_key").isNotNull()).groupBy("record_id", "ref_key").agg(F.min("at").alias("at"))
    linked = law_documents.groupBy(F.col("id").alias("record_id")).agg(F.min("created_at").alias("made_at"))
    a = orphan_references(links, documents.drop("id")).join(linked, "record_id").withColumn("record_table", F.lit("law_documents"))
    b = orphan_references(citations, cited).join(asked, "record_id").withColumn("record_table", F.lit("eval_questions"))
    return a.unionByName(b).select("record_table", "record_id", "ref_key", "orphan_kind", "made_at")


def orphan_report(orphans: DataFrame, period: str = "month") -> DataFrame:
    """Orphans counted per table, period of the referring row and kind; rows without a date come under a null period."""
    return orphans.groupBy("record_table", F.to_date(F.date_trunc(period, F.col("made_at"))).alias("period"), "orphan_kind").agg(F.count("*").alias("orphans"))
