"""Streams of samples: keyed groups that are emitted when complete, idempotent task checkpoints.

There is no time-out: a group that never completes stays in state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def complete_groups(samples: DataFrame, key: str, reward: str, group_size: int, keep: Callable[[list[float]], bool] | None = None, order: str | None = None) -> DataFrame:
    """A stream of (key, n, mean_reward, kept) for each group as it reaches its size; state is then dropped.
    Samples of a batch join their group by ``order``, so that a replayed batch makes the same groups.

    What is kept of a group is its rewards, so state is bounded by the groups still open."""
    kind = samples.schema[key].dataType.simpleString()

    def update(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rewards = list(state.get[0]) if state.exists else []
        out = []
        new = pd.concat(list(batches))
        rewards += [float(x) for x in (new.sort_values(order, kind="stable") if order else new)[reward]]
        while len(rewards) >= group_size:
            group, rewards = rewards[:group_size], rewards[group_size:]
            out.append((k[0], group_size, sum(group) / group_size, bool(keep(group)) if keep else True))
        if rewards:
            state.update((rewards,))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=[key, "n", "mean_reward", "kept"])

    return samples.groupBy(key).applyInPandasWithState(update, f"{key} {kind}, n int, mean_reward double, kept boolean", "rewards array<double>", "append", GroupStateTimeout.NoTimeout)


def spread(rewards: list[float]) -> bool:
    """Whether a group's sample deviation is above 1e-6."""
    m = sum(rewards) / len(rewards)
    return len(rewards) > 1 and (sum((r - m) ** 2 for r in rewards) / (len(rewards) - 1)) ** 0.5 > 1e-6


def drop_counts(groups: DataFrame, reason: str = "reason") -> DataFrame:
    return groups.where(F.col(reason).isNotNull()).groupBy(reason).agg(F.count("*").alias("n"))


def remaining(tasks: DataFrame, done: DataFrame, key: str = "fingerprint") -> DataFrame:
    """Tasks that no checkpoint holds."""
    return tasks.join(done.select(key).distinct(), key, "left_anti")


def checkpoint_tasks(stream: DataFrame, path: str, checkpoint: str, key: str = "fingerprint", buckets: int = 64):
    """A running query that appends each task's result once: a batch that is replayed after a
    failure, or a task that comes again, adds nothing.

    Results are in a folder a bucket of the key's hash (``buckets``), and a batch reads those that its
    keys fall into, only their key column."""

    def write(batch: DataFrame, _: int) -> None:
        rows = batch.dropDuplicates([key]).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
        spark = batch.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            touched = [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # at most ``buckets``
            schema = f"`{key}` {batch.schema[key].dataType.simpleString()}, bucket long"
            done = spark.read.schema(schema).parquet(path).where(F.col("bucket").isin(touched)).select(key)
            rows = rows.join(done, key, "left_anti")
        rows.write.mode("append").partitionBy("bucket").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()


def first_completed(groups: DataFrame, arrived: str, kept: str, target: int) -> DataFrame:
    """The batch form of oversampling: of the groups kept, the first ``target`` to arrive."""
    return groups.where(F.col(kept)).orderBy(arrived).limit(target)


def buffer_first(buffer: DataFrame, dataset: DataFrame, order: str, n: int) -> DataFrame:
    """The oldest buffered rows, then rows of the dataset, ``n`` in all."""
    both = buffer.withColumn("_p", F.lit(0)).unionByName(dataset.withColumn("_p", F.lit(1)))
    return both.orderBy("_p", order).limit(n).drop("_p")
