"""A repeatable table sink for streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything available; each batch owns the directory ``batch_id=<n>`` under ``path``."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    q = (stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
