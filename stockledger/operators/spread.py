"""Tasks by the size of the input.

The number of shuffle partitions is one for all sizes, and adaptive execution merges partitions up to 64 MB of compressed rows, which a sort or
a hash map may unfold tenfold. Where a step sorts or hashes rows it cannot thin out first, a task's memory then grows with the input. Such a step is
dealt by its own key to one task for every few MB of the files its rows come from, so a task's share is the same at all sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Stored (compressed) bytes a task, and the number of tasks below which the plan is left as it is.
TASK_BYTES = 4 << 20
LEAST_TASKS = 16


def tasks_for(*inputs: DataFrame) -> int | None:
    """The tasks that the files behind the inputs ask for; none for small inputs, for streams and where there are no files. Runs no job."""
    if any(df.isStreaming for df in inputs):
        return None
    tasks = sum(map(_size, {f: df for df in inputs for f in df.inputFiles()}.items())) // TASK_BYTES
    return tasks if tasks >= LEAST_TASKS else None


def _size(file: tuple[str, DataFrame]) -> int:
    context = file[1].sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(file[0]))
    return path.getFileSystem(context._jsc.hadoopConfiguration()).getFileStatus(path).getLen()


def spread(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """The rows dealt by the keys to so many tasks; as they are where none are asked for."""
    return df.repartition(tasks, *keys) if tasks else df
