"""Rows dealt to tasks by what they cost, for work that is expensive per row.

A scan cuts files by row groups and a join by keys, and neither knows that one row takes a thousand times as long as another.
Here the cost of all rows before a row decides its task: the running sum over the partitions as they are, cut into equal
stretches. Rows stay in order, a row that costs as much as a stretch has a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Cost of a task's rows beyond which there are more tasks than cores.
COST_PER_TASK = 64 << 20
MOST_TASKS = 100_000
_COST, _TASK = "_cost_of_row", "_task_of_row"


def deal_by_cost(df: DataFrame, cost: Column, per_task: int = COST_PER_TASK, tasks: int | None = None) -> DataFrame:
    """The same rows, in tasks of about equal cost.

    The frame is read twice: once for the sums of its partitions, one number each, and once to be dealt, so hand in a written
    one. Should its partitions differ between the two readings, tasks are less even and rows are the same. ``tasks`` is
    the number of tasks if the cost shall not decide it. Null costs are none; no row costs less than one.
    """
    context = df.sparkSession.sparkContext
    costed = df.withColumn(_COST, F.greatest(F.lit(1), F.coalesce(cost.cast("bigint"), F.lit(1))))
    sums = {r["part"]: r["cost"] for r in costed.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(_COST).alias("cost")).collect()}
    total = sum(sums.values())
    if not total:
        return df
    wanted = tasks or min(MOST_TASKS, max(context.defaultParallelism, -(-total // per_task)))
    before, offsets = 0, {}
    for part in sorted(sums):
        offsets[part] = before
        before += sums[part]
    schema = T.StructType([*df.schema, T.StructField(_TASK, T.IntegerType())])
    arrow = to_arrow_schema(schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = offsets.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            costs = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            ends = at + np.cumsum(costs)
            # The middle of a row decides, so that a large one is not drawn to the stretch it only begins in.
            middle = ends - (costs + 1) // 2
            task = np.clip(middle * wanted // total, 0, wanted - 1).astype(np.int32)
            at = int(ends[-1]) if len(ends) else at
            columns = [*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(task)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    dealt = costed.mapInArrow(number, schema)
    return dealt.repartitionById(wanted, F.col(_TASK)).drop(_TASK)
