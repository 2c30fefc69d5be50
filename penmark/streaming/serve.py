"""Score requests as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from penmark.operators.score import batch_error, explode_batch


def score_stream(
    requests: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    body: str = "body",
    keys: tuple[str, ...] = ("request_id",),
) -> StreamingQuery:
    """Score all requests that have arrived, then stop.

    ``scorer`` maps rows with ``text`` to scored rows with the batch operators. Scored
    rows go to ``out/scored``, refused requests and refused rows to ``out/refused``. Each
    micro-batch overwrites its own folder, so a repeated batch does not repeat rows.
    """
    key_list = list(keys)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            rows = explode_batch(batch, body, key_list)
            scored = scorer(rows.where("error IS NULL").drop("error"))
            scored.write.mode("overwrite").parquet(f"{out}/scored/batch={batch_id}")
            whole = batch.select(*key_list, F.lit(None).cast("int").alias("index"), batch_error(F.col(body)).alias("error"))
            single = rows.select(*key_list, "index", "error")
            refused = whole.unionByName(single).where("error IS NOT NULL")
            refused.write.mode("overwrite").parquet(f"{out}/refused/batch={batch_id}")
        finally:
            batch.unpersist()

    return (
        requests.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
