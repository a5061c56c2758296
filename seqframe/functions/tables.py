"""Table functions for SQL: ``select ... from reads, lateral kmers(seq, 12)``."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


@udtf(returnType="pos int, kmer string")
class Kmers:
    """The k-mers of a sequence with their places (1-based)."""

    def eval(self, seq: str, k: int) -> Iterator[tuple[int, str]]:
        for at in range(len(seq or "") - k + 1):
            yield at + 1, seq[at : at + k]


@udtf(returnType="pos int, base string, length int")
class Runs:
    """The runs of equal letters of a sequence."""

    def eval(self, seq: str) -> Iterator[tuple[int, str, int]]:
        begin = 0
        for at in range(1, len(seq or "") + 1):
            if at == len(seq) or seq[at] != seq[begin]:
                yield begin + 1, seq[begin], at - begin
                begin = at


def register(spark: SparkSession) -> None:
    """Make ``kmers`` and ``runs`` known to SQL."""
    spark.udtf.register("kmers", Kmers)
    spark.udtf.register("runs", Runs)
