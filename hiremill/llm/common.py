"""Helpers the corpus operators share: reading, held-out folds, bounded samples, text chunks."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CHUNK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``: which rows are held out."""
    return F.crc32(F.col(doc_id).cast("string")) % parts


def whole(text: str = "text") -> Column:
    """The text, NULL as the empty one."""
    return F.coalesce(F.col(text), F.lit(""))


def sample_by_hash(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest hash of ``key``: the same ones on every run."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(17)), key).limit(most)


def byte_chunks(text: str, overlap: int = 0) -> Iterator[np.ndarray]:
    """The UTF-8 bytes in pieces of bounded length; each piece starts ``overlap`` bytes before the last one's end."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    at = 0
    while True:
        yield data[at : at + CHUNK]
        if at + CHUNK >= len(data):
            return
        at += CHUNK - overlap


def worker_memory(name: str) -> dict:
    """A dict that lives as long as the Python process: the library's code is sent anew with each task, this module is not."""
    memory = sys.modules.setdefault("hiremill_worker_memory", types.ModuleType("hiremill_worker_memory"))
    return vars(memory).setdefault(name, {})


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -50.0, 50.0)))


def map_frames(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``mapInPandas`` that keeps integers beside a NULL: there they are Python numbers, never floats.

    ``run`` must not put such a column into a frame without ``dtype=object``.
    """
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def arrow(batches):
        frames = (batch.to_pandas(integer_object_nulls=True) for batch in batches)
        for frame in run(frames):
            yield pa.RecordBatch.from_pandas(frame, schema=fields, preserve_index=False)

    return df.mapInArrow(arrow, schema)
