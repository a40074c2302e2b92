"""What changed between consecutive full snapshots of a keyed table.

Rows of all snapshots are range-partitioned and sorted by (group, pair of snapshots, key). Within a range two streams, the rows of the older
and those of the newer snapshot of each pair, advance side by side: equal keys are compared, a key in one stream only was added or removed.
A row is used at most twice (once as older, once as newer), only keys and digests travel, and a group that holds most of the rows is cut into
as many ranges as its size asks for, so no task ever holds a snapshot. Snapshots can be kept in ranges, sorted by key; a new delivery is then merged
with its neighbours in the order alone, and nothing older is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qanat.functions.columns import number_key, version_number, visual_digest
from qanat.session import cut_lineage, partitions

OLDER, NEWER = 0, 1


def consecutive(snapshots: DataFrame, group: str, number: Column, snapshot: str) -> DataFrame:
    """(snapshot_id, group_id, next_id, has_previous) of each snapshot: the snapshots of a group in the order of number, which need not be dense.

    Rows whose number, group or id is null are no snapshots. Equal numbers of one group are put in the order of their ids.
    """
    rows = snapshots.select(F.col(snapshot).alias("snapshot_id"), F.col(group).alias("group_id"), number.alias("_number")).dropna().dropDuplicates(["snapshot_id"])
    order = Window.partitionBy("group_id").orderBy("_number", "snapshot_id")
    return rows.select("snapshot_id", "group_id", F.lead("snapshot_id").over(order).alias("next_id"), F.lag("snapshot_id").over(order).isNotNull().alias("has_previous"))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two cursors over rows sorted by (pair_id, key, side). All rows of one (pair_id, key) are one step; digests of a side are a set."""
    held, pair, key = (set(), set()), None, None
    out: tuple[list, list, list] = ([], [], [])

    def step() -> None:
        old, new = held
        kind = "added" if not old else "removed" if not new else "changed" if old != new else None
        if kind and pair is not None:
            for values, value in zip(out, (pair, key, kind)):
                values.append(value)

    for batch in batches:
        pairs, keys, sides, digests = (c.to_pylist() for c in batch.columns)
        for p, k, side, digest in zip(pairs, keys, sides, digests):
            if k != key or p != pair:
                step()
                held, pair, key = (set(), set()), p, k
            held[side].add(digest)
        if len(out[0]) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in out], ["snapshot_id", "key", "change_kind"])
            out = ([], [], [])
    step()
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in out], ["snapshot_id", "key", "change_kind"])


def snapshot_changes(rows: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Typed changes of every snapshot against the one before it.

    rows: snapshot_id, key, digest (what is compared); rows with a null snapshot or key are ignored, a null digest equals only a null digest.
    Repeated keys of a snapshot count as the set of their digests. snapshots: the result of consecutive().
    Returns snapshot_id (the later one), key, change_kind: added, removed or changed. An empty table gives no rows; the first snapshot of a
    group has nothing before it, so it gives none. A snapshot without rows is empty: all of the one before was removed.
    """
    spark = rows.sparkSession
    own = rows.select("snapshot_id", "key", "digest").where(F.col("snapshot_id").isNotNull() & F.col("key").isNotNull())
    placed = own.join(snapshots, "snapshot_id")
    sides = F.filter(
        F.array(
            F.struct(F.when(F.col("has_previous"), F.col("snapshot_id")).alias("pair_id"), F.lit(NEWER).alias("side")),
            F.struct(F.col("next_id").alias("pair_id"), F.lit(OLDER).alias("side")),
        ),
        lambda s: s["pair_id"].isNotNull(),
    )
    streams = placed.select("key", "digest", F.explode(sides).alias("s")).select("s.pair_id", "key", "s.side", "digest")
    ranged = streams.repartitionByRange(partitions(spark), "pair_id", "key").sortWithinPartitions("pair_id", "key", "side")
    return ranged.mapInArrow(_merge, "snapshot_id string, key string, change_kind string")


_KEPT = ("snapshot_id", "key", "digest")


def keep_snapshots(rows: DataFrame, path: str) -> None:
    """Appends the rows (snapshot_id, key, digest) of delivered snapshots to the kept ones below path: in ranges of snapshot and key, sorted."""
    own = rows.select(*_KEPT).where(F.col("snapshot_id").isNotNull() & F.col("key").isNotNull())
    own.repartitionByRange(partitions(rows.sparkSession), "snapshot_id", "key").sortWithinPartitions("snapshot_id", "key").write.mode("append").parquet(path)


def delivered_changes(rows: DataFrame, snapshots: DataFrame, path: str) -> DataFrame:
    """The changes that newly delivered snapshots bring: of each against the one before it, and of the one behind it against it.

    rows: snapshot_id, key, digest of the new snapshots; snapshots: the result of consecutive() over old and new ones; path: where the old ones are
    kept. Of these only the neighbours of the new ones are read. New snapshots that were kept already must not be among the rows.
    """
    new = rows.select(F.col("snapshot_id").alias("new_id")).distinct()
    order = snapshots.join(new, F.col("snapshot_id") == F.col("new_id"), "left").withColumn("is_new", F.col("new_id").isNotNull()).drop("new_id")
    of = order.select(F.col("snapshot_id").alias("next_id"), F.col("is_new").alias("next_is_new"))
    pairs = order.join(of, "next_id", "left").where("is_new OR coalesce(next_is_new, false)")
    asked = cut_lineage(pairs.where("next_id IS NOT NULL").select("snapshot_id", "next_id").distinct())
    needed = asked.select("snapshot_id").unionByName(asked.select(F.col("next_id").alias("snapshot_id"))).distinct().join(new, F.col("snapshot_id") == F.col("new_id"), "left_anti")
    kept = rows.sparkSession.read.parquet(path).select(*_KEPT).join(needed, "snapshot_id", "left_semi")
    both = asked.select("snapshot_id", "next_id").join(asked.select(F.col("next_id").alias("snapshot_id"), F.lit(True).alias("has_previous")), "snapshot_id", "full_outer")
    return snapshot_changes(kept.unionByName(rows.select(*_KEPT)), both.withColumn("has_previous", F.coalesce("has_previous", F.lit(False))))


def version_changes(articles: DataFrame, documents: DataFrame) -> DataFrame:
    """Articles added, removed and changed in each delivered version of a source: document_id, article_number, change_kind.

    Deleted versions and versions without a number are no snapshots; articles of unknown documents are ignored. A text is text_ar, or
    text_en where text_ar is null or empty; texts that look the same are equal.
    """
    status = F.coalesce(F.col("metadata.status"), F.lit(""))
    order = consecutive(documents.where(status != "deleted"), "source_id", version_number(F.col("version")), "id")
    text = F.coalesce(F.when(F.col("text_ar") != "", F.col("text_ar")), F.col("text_en"), F.lit(""))
    rows = articles.where(F.col("article_number").isNotNull() & F.col("document_id").isNotNull()).select(F.col("document_id").alias("snapshot_id"), number_key(F.col("article_number")).alias("key"), visual_digest(text).alias("digest"))
    return snapshot_changes(rows, order).select(F.col("snapshot_id").alias("document_id"), F.col("key").alias("article_number"), "change_kind")
