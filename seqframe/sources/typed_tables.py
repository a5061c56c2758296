"""Annotation tables with types, keys and references: read, checked, and loaded all together or not at all."""

from __future__ import annotations

import functools
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqframe.sources.paths import shared_folder


@dataclass(frozen=True)
class TypedTable:
    """columns: ``name type`` words, type int, text or the greatest number of letters; a ! after the type means not null.

    references: column -> (table, column). A primary key is unique and not null, a unique key is unique where it has no null.
    """

    columns: str
    key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()
    header: bool = True

    @property
    def fields(self) -> list[tuple[str, str, bool]]:
        words = self.columns.split()
        return [(c, t.rstrip("!"), t.endswith("!") or c in self.key) for c, t in zip(words[::2], words[1::2], strict=True)]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.IntegerType() if t == "int" else T.StringType()) for c, t, _ in self.fields])


# Columns, types, keys and references of the annotation tables, in the order of their references.
PLACE = "strand 1 start_pos int end_pos int"
TABLES = {
    "source": TypedTable(f"genomicid 36 {PLACE} mol_type 24 chromosome int organism 100", ("genomicid",)),
    "gene": TypedTable(f"genomicid 36! {PLACE} id 36 attribute text", ("id",), (("genomicid", "strand", "start_pos", "end_pos"),), (("genomicid", "source", "genomicid"),)),
    "transcript": TypedTable("transcriptid 36 rna_type 12 geneid 36 attribute text", ("transcriptid",), (), (("geneid", "gene", "id"),)),
    "exon": TypedTable(f"genomicid 36! {PLACE} exon_number int transcriptid 36", ("transcriptid", "exon_number"), (), (("genomicid", "source", "genomicid"), ("transcriptid", "transcript", "transcriptid"))),
    "protein": TypedTable("proteinid 36 geneid 36 product 250 attribute text", ("proteinid",), (), (("geneid", "gene", "id"),)),
    "cds": TypedTable("genomicid 36! strand 1 phase int start_pos int end_pos int id 70 exon_number int proteinid 36", ("proteinid", "exon_number"), (), (("proteinid", "protein", "proteinid"),)),
    "start_codon": TypedTable(f"genomicid 36 {PLACE} proteinid 36", ("proteinid", "start_pos"), (), (("proteinid", "protein", "proteinid"),)),
    "stop_codon": TypedTable(f"genomicid 36 {PLACE} proteinid 36", ("proteinid", "start_pos"), (), (("proteinid", "protein", "proteinid"),)),
    "proteinseq": TypedTable("gi int proteinid 36! title text sequence text!", ("gi",), (("proteinid",),), header=False),
    "genomicseq": TypedTable("gi int genomicid 36! title text sequence text!", ("gi",), (("genomicid",),), header=False),
}


class LoadRefused(ValueError):
    """A load with problems; ``problems`` has them counted by table, column and kind."""

    def __init__(self, problems: list[tuple[str, str, str, int]]) -> None:
        super().__init__("; ".join(f"{t}.{c}: {p} ({n})" for t, c, p, n in problems))
        self.problems = problems


def read_typed_text(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A tab-separated file of one table, all columns as text (``\\N`` is null); types are checked by ``problems``."""
    spec = TABLES[name]
    schema = T.StructType([T.StructField(c, T.StringType()) for c, _, _ in spec.fields])
    return spark.read.schema(schema).csv(path, sep="\t", header=spec.header, enforceSchema=True, quote="", nullValue="\\N", emptyValue="")


def typed(df: DataFrame, name: str) -> DataFrame:
    """The columns of the table with their types; what can't be read as a number is null."""
    return df.select(*[(F.col(c).try_cast("int") if t == "int" else F.col(c).cast("string")).alias(c) for c, t, _ in TABLES[name].fields])


def _row_problems(df: DataFrame, name: str) -> DataFrame:
    """(table_name, column_name, problem, n) seen in single rows, in one pass."""
    found: list[Column] = []
    for c, t, needed in TABLES[name].fields:
        rules = [("null", F.col(c).isNull())] if needed else []
        rules += [("not a number", F.col(c).isNotNull() & F.col(c).cast("string").try_cast("int").isNull())] if t == "int" else []
        rules += [("too long", F.length(F.col(c).cast("string")) > int(t))] if t.isdigit() else []
        found += [F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("problem"), F.count(F.when(rule, 1)).alias("n")) for p, rule in rules]
    counts = df.agg(F.array(*found).alias("p")).select(F.explode("p").alias("p"))
    return counts.select(F.lit(name).alias("table_name"), "p.column_name", "p.problem", "p.n").filter("n > 0")


def _repeated(df: DataFrame, name: str, key: tuple[str, ...], stored: DataFrame) -> DataFrame:
    """New rows whose key another row, new or stored, has too; keys with a null are left to the other rules."""
    whole = functools.reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
    both = df.select(*key, F.lit(1).alias("new")).unionByName(stored.select(*key, F.lit(0).alias("new"))).filter(whole)
    groups = both.groupBy(*key).agg(F.count("*").alias("rows"), F.sum("new").alias("n")).filter("rows > 1 and n > 0")
    return groups.agg(F.sum("n").alias("n")).select(F.lit(name).alias("table_name"), F.lit(",".join(key)).alias("column_name"), F.lit("repeated key").alias("problem"), "n").filter("n > 0")


def _dangling(df: DataFrame, name: str, column: str, other: DataFrame, target: str, target_name: str) -> DataFrame:
    """New rows whose reference is no key of the other table. References are counted by value first, so that a frequent one is one row."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("k")).agg(F.count("*").alias("n"))
    lost = counted.join(other.select(F.col(target).alias("k")), "k", "left_anti")
    return lost.agg(F.sum("n").alias("n")).select(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), F.lit(f"not in {target_name}").alias("problem"), "n").filter("n > 0")


def problems(tables: dict[str, DataFrame], stored: dict[str, DataFrame] | None = None) -> DataFrame:
    """(table_name, column_name, problem, n): what forbids to load these tables (as text or typed) beside the stored ones; empty if nothing does.

    At most one row for each table and rule, whatever the number of rows. Columns that the table doesn't have are ignored, missing ones are an error.
    The tables are staged as text first, as every rule looks at them.
    """
    return _staged_problems(_staged(tables), stored)


def _staged(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The columns of the tables as text, written once to the shared folder."""
    out = {}
    for name, df in tables.items():
        spark, path = df.sparkSession, shared_folder(df.sparkSession, f"staged-{name}")
        df.select(*[F.col(c).cast("string").alias(c) for c, _, _ in TABLES[name].fields]).write.parquet(path)
        out[name] = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c, _, _ in TABLES[name].fields])).parquet(path)
    return out


def _staged_problems(tables: dict[str, DataFrame], stored: dict[str, DataFrame] | None = None) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    empty = lambda name: spark.createDataFrame([], TABLES[name].schema)
    have = {name: (stored or {}).get(name, empty(name)) for name in TABLES}
    new = {name: typed(df, name) for name, df in tables.items()}
    parts = []
    for name, df in new.items():
        spec = TABLES[name]
        parts.append(_row_problems(tables[name], name))
        parts += [_repeated(df, name, key, have[name]) for key in (spec.key, *spec.unique)]
        for column, other, target in spec.references:
            known = have[other].select(target)
            parts.append(_dangling(df, name, column, known.unionByName(new[other].select(target)) if other in new else known, target, other))
    return functools.reduce(DataFrame.unionByName, parts)


def stored_table(spark: SparkSession, target: str, name: str) -> DataFrame:
    """A table under target with the rows of all finished loads; empty if there is none."""
    schema = TABLES[name].schema
    try:
        done = spark.read.schema("load string").parquet(f"{target}/loads")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("load", T.StringType())])).option("basePath", f"{target}/{name}").parquet(f"{target}/{name}")
    return rows.join(done.distinct(), "load", "left_semi").drop("load")


def load_tables(tables: dict[str, DataFrame], target: str) -> str:
    """Load the tables into folders under target, all or none; the id of the load.

    The new rows are staged in the shared folder and checked there, then written under the load's id; only a last row in ``loads`` makes
    them visible, so a job that dies before that leaves the target as it was. Raises LoadRefused. One load at a time.
    """
    unknown = sorted(set(tables) - set(TABLES))
    if unknown or not tables:
        raise ValueError(f"no such tables: {unknown}" if unknown else "no tables")
    spark = next(iter(tables.values())).sparkSession
    staged = _staged(tables)
    found = _staged_problems(staged, {name: stored_table(spark, target, name) for name in TABLES}).collect()
    if found:
        raise LoadRefused(sorted((r["table_name"], r["column_name"], r["problem"], r["n"]) for r in found))
    load = uuid.uuid4().hex
    for name in TABLES:
        rows = typed(staged[name], name) if name in staged else spark.createDataFrame([], TABLES[name].schema)
        rows.write.parquet(f"{target}/{name}/load={load}")
    spark.createDataFrame([(load,)], "load string").write.mode("append").parquet(f"{target}/loads")
    return load
