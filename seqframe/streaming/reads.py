"""The running accumulators over Structured Streaming: files of reads that arrive one after another."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from seqframe.functions import sequence as S


def stream_table(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """Parquet files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def cleaned(reads: DataFrame, least: int = 26, quality: float = 20, most_n: int = 1) -> DataFrame:
    """Reads with Ns cut from their ends that keep ``least`` letters, have a mean quality of at least ``quality`` and at most ``most_n`` Ns left; stateless, so the same on a stream and on a table."""
    mean = S.quality_sum("qual") / F.size("qual")
    return reads.filter(mean >= quality).withColumn("seq", S.trim_n_ends("seq")).filter((F.length("seq") >= least) & (S.count_of("seq", "Nn") <= most_n))


def running_statistics(reads: DataFrame, arrived: str = "arrived", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Reads, bases, GC and mean quality of each window of arrival (update mode)."""
    t = reads.withWatermark(arrived, late)
    n = F.length("seq")
    g = t.groupBy(F.window(arrived, window).alias("w")).agg(F.count("*").alias("n_reads"), F.sum(n).alias("n_bases"), (F.sum(S.count_of("seq", "GC")) / F.sum(S.count_of("seq", "ACGT"))).alias("gc"), (F.sum(S.quality_sum("qual")) / F.sum(F.size("qual"))).alias("mean_quality"))
    return g.select(F.col("w.start").alias("start"), "n_reads", "n_bases", "gc", "mean_quality")


def first_wins(reads: DataFrame, on: str = "read_id", arrived: str = "arrived", late: str = "2 hours") -> DataFrame:
    """The first read of each id within the watermark."""
    return reads.withWatermark(arrived, late).dropDuplicatesWithinWatermark([on])


def pick_ids(reads: DataFrame, ids: DataFrame, on: str = "read_id", keep: bool = True) -> DataFrame:
    """Stream-static semi or anti join."""
    static = ids.select(on).distinct()
    if keep:
        return reads.join(static, on, "left_semi")
    return reads.join(static.withColumn("__hit", F.lit(True)), on, "left").filter(F.col("__hit").isNull()).drop("__hit")


def match_library(reads: DataFrame, library: DataFrame, key: int = 21) -> DataFrame:
    return reads.withColumn("sequence", F.substring("seq", 1, key)).join(library.select("sequence", "library_id"), "sequence", "left")


def pair_mates(first: DataFrame, second: DataFrame, on: str = "read_id", late: str = "2 hours") -> DataFrame:
    """Mates joined within the watermark; a read without a mate comes out once the watermark has passed it."""
    a = first.select(F.col(on).alias("id1"), F.col("seq").alias("seq1"), F.col("arrived").alias("t1")).withWatermark("t1", late)
    b = second.select(F.col(on).alias("id2"), F.col("seq").alias("seq2"), F.col("arrived").alias("t2")).withWatermark("t2", late)
    near = (F.col("id1") == F.col("id2")) & (F.col("t2") >= F.col("t1") - F.expr(f"interval {late}")) & (F.col("t2") <= F.col("t1") + F.expr(f"interval {late}"))
    return a.join(b, near, "left_outer")


STORE, ROCKSDB = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class CutStates(StatefulProcessor):
    """One integer for each project: 0 nothing yet, 1 or 2 the class seen, -1 both or another one. A project that is quiet for ``quiet_ms`` comes out once more, closed, and is forgotten."""

    def __init__(self, quiet_ms: int | None = None) -> None:
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("state", "state int")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = self.state.get()[0] if self.state.exists() else 0
        for pdf in rows:
            for cls in pdf.sort_values("ord", kind="stable")["cls"]:
                now = now if now == -1 or cls == 0 else -1 if cls not in (1, 2) or now not in (0, cls) else int(cls)
        self.state.update((now,))
        if self.quiet_ms is not None:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.quiet_ms)
        yield pd.DataFrame({"project": [key[0]], "state": [now], "closed": [False]})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last = self.state.get()[0] if self.state.exists() else 0
        self.state.clear()
        yield pd.DataFrame({"project": [key[0]], "state": [last], "closed": [True]})

    def close(self) -> None:
        pass


def cut_states(runs: DataFrame, project: str = "project", quiet_ms: int | None = None) -> DataFrame:
    """(project, state, closed) after each batch of runs (project, ord, cls), in update mode.

    Without ``quiet_ms`` projects are kept for good. Such processors need the state store of RocksDB, whose state may pass the memory of an executor: it is set for the session.
    """
    conf = runs.sparkSession.conf
    if not conf.get(STORE, "").endswith("RocksDBStateStoreProvider"):
        conf.set(STORE, ROCKSDB)
    timers = "none" if quiet_ms is None else "processingTime"
    return runs.groupBy(project).transformWithStateInPandas(CutStates(quiet_ms), "project long, state int, closed boolean", "update", timers)
