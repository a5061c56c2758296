"""Sequence tables derived from the driver's tables, equal in Spark SQL and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

VIEWS = {
    "fx_refs": """
        select 'p' || cast(p_partkey as varchar(20)) as ref_id, p_name as title,
               translate(md5(cast(p_partkey as varchar(20))) || md5('x' || cast(p_partkey as varchar(20))),
                         '0123456789abcdef', 'ACGTACGTACGTACGT') as seq
        from part""",
    "fx_reads": """
        select read_id || '.' || cast(row_number() over (partition by read_id order by ref_id, seq, qual33) as varchar(20)) as read_id,
               ref_id, src, ord * 100 + row_number() over (partition by read_id order by ref_id, seq, qual33) as ord, seq, qual33
        from (select read_id, ref_id, src, ord,
               case when ord % 2 = 1 then reverse(translate(s, 'ACGT', 'TGCA')) else s end as seq,
               substr(translate(md5(read_id) || md5('q' || read_id), '0123456789abcdef', '+-/13579;=?ACEGI'),
                      1, cast(length(s) as int)) as qual33
        from (select 'r' || cast(l_orderkey as varchar(20)) || '_' || cast(l_linenumber as varchar(20)) as read_id,
                     r.ref_id as ref_id, 'f' || cast(l_suppkey % 4 as varchar(20)) as src,
                     l_orderkey * 10 + l_linenumber as ord,
                     substr(concat(substr(r.seq, 1, cast(l_suppkey % 64 as int)),
                                   substr('ACGTN', cast(l_orderkey % 5 as int) + 1, 1),
                                   substr(r.seq, cast(l_suppkey % 64 as int) + 2)),
                            1, cast(24 + l_orderkey % 41 as int)) as s
              from lineitem join fx_refs r on r.ref_id = 'p' || cast(l_partkey as varchar(20))) t) u""",
    "fx_hits": """
        select 'q' || cast(l_orderkey as varchar(20)) as query, 't' || cast(l_partkey % 7 as varchar(20)) as target,
               l_discount as identity, cast(floor(l_quantity) as int) as length,
               1 + (l_suppkey * 7) % 300 as qstart, (l_suppkey * 7) % 300 + cast(floor(l_quantity) as int) as qend,
               1 + (l_partkey * 11) % 500 as tstart, (l_partkey * 11) % 500 + cast(floor(l_quantity) as int) as tend,
               cast(l_linenumber as double) / 1000 as evalue, cast(floor(l_extendedprice / 100) as int) as score,
               (l_orderkey * 10 + l_linenumber) * 100 + row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount) as ord
        from lineitem""",
    "fx_exons": """
        select 'chr' || cast(l_orderkey % 5 as varchar(20)) as genomicid,
               case when l_orderkey % 2 = 0 then '+' else '-' end as strand, 't' || cast(l_orderkey as varchar(20)) as transcript_id,
               'g' || cast(l_orderkey % 700 as varchar(20)) as gene_id,
               (l_orderkey % 1000) * 1000 + l_linenumber * 120 as start_pos,
               (l_orderkey % 1000) * 1000 + l_linenumber * 120 + 20 + cast(floor(l_quantity) as int) as end_pos
        from lineitem""",
    "fx_tax": """
        select 0 as taxid, cast(null as int) as parent, 'root' as name
        union all select 1 + r_regionkey, 0, r_name from region
        union all select 100 + n_nationkey, 1 + n_regionkey, n_name from nation
        union all select 1000 + cast(s_suppkey as int), 100 + s_nationkey, s_name from supplier""",
    "fx_old": """
        select 'AC' || cast(p_partkey as varchar(20)) as accession, 1 + p_size % 3 as version from part where p_partkey % 3 <> 0""",
    "fx_new": """
        select 'AC' || cast(p_partkey as varchar(20)) as accession, cast(1 + p_partkey % 4 as int) as version from part where p_partkey % 5 <> 0""",
    "fx_clusters": """
        select 'cl' || cast(p_partkey % 200 as varchar(20)) as cluster_id, 'p' || cast(p_partkey as varchar(20)) as seq_id from part""",
    "fx_runs": """
        select user_id as project, event_id as ord,
               case event_type when 'error' then 0 when 'click' then 1 else 2 end as cls from events""",
}
# Alignments of the reads as they were planted (SQL only): the read turned back, clipped by one letter where that differs at an end.
VIEWS["fx_aln"] = """
        select *, 10 * (n - m) - 9 * m * (1 - lo - hi) as score, n - lo - hi as alnlen, (n - m) * 1.0 / (n - lo - hi) as identity
        from (select *, case when s <> substr(ref, 1, n) then 1 else 0 end as m, case when substr(s, 1, 1) <> substr(ref, 1, 1) then 1 else 0 end as lo,
                     case when substr(s, n, 1) <> substr(ref, n, 1) then 1 else 0 end as hi
              from (select d.read_id, d.ref_id, case when (ord // 100) % 2 = 1 then '-' else '+' end as strand, r.seq as ref, cast(length(d.seq) as int) as n,
                           case when (ord // 100) % 2 = 1 then reverse(translate(d.seq, 'ACGT', 'TGCA')) else d.seq end as s,
                           case when (ord // 100) % 2 = 1 then reverse(qual33) else qual33 end as q33
                    from fx_reads d join fx_refs r on d.ref_id = r.ref_id) a) b"""
VIEWS["fx_cols"] = """
        select read_id, ref_id, pos, substr(s, cast(pos as int), 1) as base, ascii(substr(q33, cast(pos as int), 1)) - 33 as q
        from (select *, unnest(range(1 + lo, n - hi + 1)) as pos from fx_aln) a"""
NEEDS = {"fx_reads": ["fx_refs"], "fx_aln": ["fx_refs", "fx_reads"], "fx_cols": ["fx_refs", "fx_reads", "fx_aln"]}


def with_views(*names: str) -> str:
    """A WITH clause that defines the named views (and those they read)."""
    order: list[str] = []
    for name in names:
        for x in [*NEEDS.get(name, []), name]:
            if x not in order:
                order.append(x)
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in order) + "\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived view as a DataFrame, planned from the Parquet tables."""
    import re

    sql = with_views(name) + f"select * from {name}"
    used = {t: table(spark, sf_dir, t) for t in ("region", "nation", "supplier", "part", "lineitem", "events") if re.search(rf"\b(from|join) {t}\b", sql)}
    for t in used:
        sql = re.sub(rf"\b(from|join) {t}\b", rf"\1 {{{t}}}", sql)
    return spark.sql(sql, **used)


def refs(spark, sf_dir):
    return view(spark, sf_dir, "fx_refs")


def reads(spark, sf_dir):
    """``fx_reads`` with only the keys of ``lineitem`` sent through the shuffle: texts follow from them.

    A read's qual33 follows from read_id and length, so among rows of one id it orders nothing that seq has not.
    """
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    known = keys.join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey")), "l_partkey")
    rows = known.repartition("l_orderkey", "l_linenumber")
    text = lambda c: F.col(c).cast("string")
    letters = F.translate(F.concat(F.md5(text("l_partkey")), F.md5(F.concat(F.lit("x"), text("l_partkey")))), "0123456789abcdef", "ACGTACGTACGTACGT")
    at = F.col("l_suppkey") % 64
    rows = rows.withColumn("__r", letters).withColumn("__id", F.concat(F.lit("r"), text("l_orderkey"), F.lit("_"), text("l_linenumber")))
    changed = F.concat(F.substring("__r", F.lit(1), at.cast("int")), F.substring(F.lit("ACGTN"), (F.col("l_orderkey") % 5 + 1).cast("int"), F.lit(1)), F.substring("__r", (at + 2).cast("int"), F.lit(64)))
    cut = rows.withColumn("__s", F.substring(changed, F.lit(1), (24 + F.col("l_orderkey") % 41).cast("int")))
    ord_ = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    seq = F.when(ord_ % 2 == 1, F.reverse(F.translate("__s", "ACGT", "TGCA"))).otherwise(F.col("__s"))
    cut = cut.withColumn("seq", seq).withColumn("ref_id", F.concat(F.lit("p"), text("l_partkey")))
    number = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("ref_id", "seq"))
    qual = F.translate(F.concat(F.md5("__id"), F.md5(F.concat(F.lit("q"), F.col("__id")))), "0123456789abcdef", "+-/13579;=?ACEGI")
    return cut.withColumn("__k", number).select(
        F.concat("__id", F.lit("."), text("__k")).alias("read_id"), "ref_id", F.concat(F.lit("f"), (F.col("l_suppkey") % 4).cast("string")).alias("src"), (ord_ * 100 + F.col("__k")).alias("ord"), "seq",
        F.substring(qual, F.lit(1), F.length("__s")).alias("qual33"),
    )


def hits(spark, sf_dir):
    return view(spark, sf_dir, "fx_hits")


def exons(spark, sf_dir):
    return view(spark, sf_dir, "fx_exons")


def random_letters(key: str, blocks: int = 5):
    """32 letters a block of a sequence that depends on the key alone; the same in SQL is ``random_letters_sql``."""
    return F.translate(F.concat(*[F.md5(F.concat(F.col(key), F.lit(f"/{k}"))) for k in range(blocks)]), "0123456789abcdef", "ACGTACGTACGTACGT")


def random_letters_sql(key: str, blocks: int = 5) -> str:
    return "translate(" + " || ".join(f"md5({key} || '/{k}')" for k in range(blocks)) + ", '0123456789abcdef', 'ACGTACGTACGTACGT')"
