"""The watch as a stream: change rows that arrive as files become notices, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qanat.operators.tenancy import watch_fanout


def stream_notices(spark: SparkSession, changes: str, documents: DataFrame, interests: DataFrame, out: str, checkpoint: str):
    """Starts a query over Parquet files of change rows (document_id, article_number, change); what is there now is worked off, then it ends.

    A batch's number names its folder, so a repeated batch overwrites itself and no notice comes twice.
    """
    rows = spark.readStream.schema("document_id string, article_number string, change string").parquet(changes)

    def notify(batch: DataFrame, number: int) -> None:
        watch_fanout(batch, documents, interests).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(notify).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
