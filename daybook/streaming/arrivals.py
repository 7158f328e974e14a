"""Loading staged files as they arrive.

A file stream remembers paths, not contents, so it cannot see a rewritten file.
Here it only serves as the signal that something arrived; each micro-batch then
runs the ledger-based load, which looks at contents and is safe to repeat.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from daybook.plans.load import load_new_files


def load_arrivals(
    spark: SparkSession, stage: str, raw: str, ledger: str, checkpoint: str
) -> StreamingQuery:
    """Start a query that loads what is staged now and then stops."""
    arrivals = spark.readStream.schema("value string, date date").text(stage)

    def load_batch(_: DataFrame, batch_id: int) -> None:
        now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
        load_new_files(spark, stage, raw, ledger, now)

    return (
        arrivals.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
