"""Incremental runs as a stream: new result files come in, entities that haven't come before are appended."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, StructField, StructType

SEEN = StructType([StructField("seen", BooleanType())])


def new_files(spark: SparkSession, folder: str, schema: str, per_batch: int = 100) -> DataFrame:
    """Parquet files of ``folder`` as a stream, at most ``per_batch`` in one batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


def first_rows(stream: DataFrame, key: str = "provider_id", pos: str = "pos") -> DataFrame:
    """The rows of ``stream`` whose key no earlier batch had; of a batch's rows with one key the first by ``pos``, then as they come.

    What has been seen is keyed state, one flag a key: a batch costs what its own keys cost, whatever came before. A null key is a key of its own.
    """
    columns = stream.columns

    def step(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # a key's rows come in portions; only the best so far is held
        best = None
        for frame in frames:
            if not state.exists:
                part = frame if best is None else pd.concat([best, frame])
                best = part.sort_values(pos, kind="stable", na_position="first").head(1)
        if best is not None:
            state.update((True,))
            yield best[columns]

    return stream.groupBy(key).applyInPandasWithState(step, stream.schema, SEEN, "append", GroupStateTimeout.NoTimeout)


def append_new(stream: DataFrame, out: str, checkpoint: str, key: str = "provider_id", pos: str = "pos") -> StreamingQuery:
    """Append each batch's new entities (``first_rows``) to ``out``. Runs until all present files are taken.

    The state lives with the checkpoint and the file sink keeps a log of finished batches, so a run that is started again after a failure adds nothing twice. What ``out`` was given
    by other means isn't known here: such rows go into the stream's folder first. ``out`` is read through Spark, which heeds the log. The state of very many keys
    belongs in RocksDB (spark.sql.streaming.stateStore.providerClass).
    """
    return first_rows(stream, key, pos).writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
