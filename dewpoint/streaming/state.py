"""What a running or stopped job has in its state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dewpoint.operators.windows import GROUPS, READINGS, SUMS, averages_of_sums


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that the job with this checkpoint has not closed yet, with their averages
    so far: ``window_start, window_end, t_avg, h_avg``.

    Read from the state of the job's last finished micro-batch, which the job need not be
    stopped for; the windows are those whose end the watermark has not reached. The
    averages are the ones that a window would be emitted with if no further reading came.
    The job is one of ``sliding_averages``; a checkpoint without its state is an error.
    """
    return averages_of_sums(sums_in_state(spark, checkpoint))


def sums_in_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The sums of the windows that were open after a micro-batch, the last one if none is
    named: ``window`` and the columns of ``GROUPS`` and ``SUMS``, and ``readings`` if the
    job is measured."""
    batch = {} if batch_id is None else {"batchId": str(batch_id)}
    operators = spark.read.format("state-metadata").load(checkpoint).select("operatorId")
    for row in operators.distinct().orderBy("operatorId").collect():  # two
        state = (
            spark.read.format("statestore")
            .options(operatorId=row.operatorId, **batch)
            .load(checkpoint)
        )
        if set(GROUPS) <= set(state.schema["key"].dataType.fieldNames()):
            break
    else:
        raise ValueError(f"no sums of sliding averages in {checkpoint}")
    # Spark names the sums by their functions; their order is that of SUMS.
    names = (*SUMS, READINGS)[: len(state.schema["value"].dataType.fields)]
    sums = F.col("value").cast("struct<" + ", ".join(f"{c}: bigint" for c in names) + ">")
    summed = state.select("key.*", sums.alias("value"))
    return summed.select("window", *GROUPS, "value.*")
