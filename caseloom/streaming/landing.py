"""A file stream that starts a run when sheets arrive.

The stream carries file names only; which sheets changed is still decided by content, in the
run itself. A batch that is repeated after a failure therefore does no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from caseloom.plans.run import run

_FILES = "path string, modificationTime timestamp, length long, content binary, sheet string"


def follow_sheets(spark: SparkSession, source: str, warehouse: str, client: DataFrame,
                  checkpoint: str | None = None, interval: str | None = None,
                  **options) -> StreamingQuery:
    """Run once for the files present now, or with ``interval`` whenever files have arrived.

    What has arrived is noted under the warehouse, unless ``checkpoint`` names another place.
    ``options`` go to the run. A file replaced under its old name is no new file for the
    stream; deliver changed sheets under new names, or run on a schedule.
    """
    arrivals = (
        spark.readStream.format("binaryFile").schema(_FILES).load(source).select("sheet", "path")
    )

    def process(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            run(spark, source, warehouse, client, **options)

    writer = arrivals.writeStream.foreachBatch(process).option(
        "checkpointLocation", checkpoint or f"{warehouse.rstrip('/')}/_arrivals"
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
