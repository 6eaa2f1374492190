"""Model calls at a bounded rate, whose answers are committed slice by slice.

Time is cut into slots of 60 / ``rpm`` seconds by the clock. Slot n belongs to lane n modulo
``lanes``, a fixed number of calling tasks, and a lane makes at most one call in a slot of its own. So all
lanes together keep to the limit, whether they run side by side or one after the other, and across slices
and restarts, without speaking to each other (up to the difference of the machines' clocks). A second attempt waits for a slot like any call.

Prompts are a stream of files. What is new is compared with the answers once, and what is open is asked in slices of
a few files; the answers of a slice are one committed append. What has
an answer there is not asked again, so a restart pays for no committed answer twice, and a
lost slice repeats at most its own calls. While a failed prompt waits, its lane asks the next ones. The number of lanes is the number of tasks at any size: the limit, not the data, bounds the work.
"""

from __future__ import annotations

import heapq
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hiremill.operators.tagging import BATCH_LOG, MAX_ATTEMPTS, Model, attempt
from hiremill.session import materialize, scratch_path

RETRY_WAIT = 5.0
CALL_TIMES = T.StructField("called_at", T.ArrayType(T.DoubleType()))


class Lane:
    """The turns of one calling task: the slots of ``every`` seconds whose number is ``number`` modulo ``lanes``."""

    def __init__(self, every: float, lanes: int, number: int, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.every, self.lanes, self.number, self.clock, self.sleep = every, lanes, number, clock, sleep
        self.last = -1

    def turn(self, wait: float = 0.0) -> float:
        """Wait for the next own slot, ``wait`` seconds at least, and return the time."""
        after = self.clock() + wait
        while True:
            slot = max(int(after // self.every), self.last) + 1
            slot += (self.number - slot) % self.lanes
            while (now := self.clock()) < slot * self.every:
                self.sleep(slot * self.every - now)
            if int(now // self.every) == slot:
                self.last = slot
                return now
            after = now  # woken too late for it


def paced_answers(
    prompts: DataFrame, model: Model, check: Callable[[object], bool], key: str, rpm: float, lanes: int, retry_wait: float = RETRY_WAIT
) -> DataFrame:
    """``tagging.ask_model`` at a bounded rate, and ``called_at``, the times of the calls. To be written once."""
    schema = T.StructType([prompts.schema[key], *BATCH_LOG.fields, CALL_TIMES])

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lane = Lane(60.0 / rpm, lanes, TaskContext.get().partitionId() % lanes)
        fresh = (row for batch in batches for row in zip(batch[key], batch["prompt"]))
        for row in lane_answers(lane, fresh, model, check, retry_wait):
            yield pd.DataFrame([row], columns=schema.names)

    return prompts.select(key, "prompt").repartition(lanes).mapInPandas(ask, schema)


def lane_answers(
    lane: Lane, prompts: Iterator[tuple[object, str]], model: Model, check: Callable[[object], bool], retry_wait: float
) -> Iterator[tuple]:
    """``(key, attempts, tokens, answer, error, called_at)`` of each ``(key, prompt)``, in the order they are done.

    A failed prompt is tried again in the first turn after its wait; until then the turns go to the next ones.
    """
    again: list[tuple] = []  # heap of (not before, number, key, prompt, times, tokens)
    fresh, number = iter(prompts), 0
    while True:
        if again and again[0][0] <= lane.clock():
            job = heapq.heappop(again)
        elif (new := next(fresh, None)) is not None:
            number += 1
            job = (0.0, number, *new, [], 0)
        elif again:
            job = heapq.heappop(again)
        else:
            return
        ready, place, name, prompt, times, tokens = job
        times.append(lane.turn(max(0.0, ready - lane.clock())))
        used, answer, error = attempt(model, prompt, check)
        tokens += used
        if error is not None and len(times) < MAX_ATTEMPTS:
            heapq.heappush(again, (lane.clock() + retry_wait, place, name, prompt, times, tokens))
        else:
            yield name, len(times), tokens, answer, error, times


def lay_out_prompts(prompts: DataFrame, folder: str, slice_rows: int) -> None:
    """Append prompts to a folder in files of at most ``slice_rows``: the slices."""
    prompts.write.mode("append").option("maxRecordsPerFile", slice_rows).parquet(folder)


def answers_in(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def answer_slices(
    spark: SparkSession, prompts: str, answers: str, checkpoint: str, model: Model, check: Callable[[object], bool], key: T.StructField,
    rpm: float, lanes: int = 2, retry_wait: float = RETRY_WAIT, files_per_slice: int = 1,
) -> StreamingQuery:
    """Ask the model about every prompt file in ``prompts`` that is new since ``checkpoint``; answers are appended to ``answers``.

    The new files are one micro-batch, whatever their number: the answers are read once for all of them.
    """
    asked = T.StructType([key, T.StructField("prompt", T.StringType())])
    schema = T.StructType([key, *BATCH_LOG.fields, CALL_TIMES])

    def ask(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        open_ = materialize(batch.join(answers_in(spark, answers, schema).select(key.name), key.name, "left_anti"), "open-prompts")
        sliced, path = in_slices(open_, key.name, files_per_slice), scratch_path(spark, "slices")
        sliced.select(*asked.names, "slice").repartition("slice").write.partitionBy("slice").parquet(path)
        numbers = sorted(r["slice"] for r in sliced.select("slice").distinct().collect())
        # Nothing open leaves an answers folder without rows.
        for part in [spark.read.schema(asked).parquet(f"{path}/slice={n}") for n in numbers] or [open_]:
            paced_answers(part, model, check, key.name, rpm, lanes, retry_wait).write.mode("append").parquet(answers)

    source = spark.readStream.schema(asked).parquet(prompts).select("*", "_metadata.file_modification_time", "_metadata.file_path")
    return source.writeStream.foreachBatch(ask).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def in_slices(prompts: DataFrame, key: str, files_per_slice: int) -> DataFrame:
    """``prompts`` with ``slice``: so many files each, oldest first. A key of several slices stays in its first; NULL keys never meet."""
    files = prompts.select("file_modification_time", "file_path").distinct()
    place = F.row_number().over(Window.orderBy("file_modification_time", "file_path"))
    numbered = files.select("file_path", F.floor((place - 1) / files_per_slice).alias("slice"))
    first = F.min("slice").over(Window.partitionBy(key, F.when(F.col(key).isNull(), F.col("slice"))))
    return prompts.join(numbered, "file_path").withColumn("first", first).filter("slice = first").drop("first")


def calls_in_slots(log: DataFrame, rpm: float) -> DataFrame:
    """One row: ``calls``, and ``most``, the largest number of calls in one slot."""
    slots = log.select(F.explode("called_at").alias("at")).groupBy(F.floor(F.col("at") / (60.0 / rpm)).alias("slot")).agg(F.count("*").alias("n"))
    return slots.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("calls"), F.coalesce(F.max("n"), F.lit(0)).alias("most"))
