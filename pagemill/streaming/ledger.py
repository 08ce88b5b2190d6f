"""The batch ledger fed by a stream of records: run again, it takes up what is new and nothing twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.ledger import current
from ..schemas import LEDGER


def follow(spark: SparkSession, source: str, out: str, checkpoint: str):
    """Appends new record files to ``out``, a folder a micro-batch, and stops when all are in."""

    def write(batch: DataFrame, epoch: int) -> None:
        # a batch that is tried again writes its own folder anew
        batch.write.mode("overwrite").json(f"{out}/epoch={epoch}")

    rows = spark.readStream.schema(LEDGER).json(source)
    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return current(spark.read.schema(LEDGER).json(out))
