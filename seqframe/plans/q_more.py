"""Queries of readers, sinks, streams, repeats, second rounds and table functions; alignments are held against planted ones."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from seqframe.functions import sequence as S
from seqframe.functions import tables
from seqframe.operators import align, annotation, assembly, clusters, gaps, pileup, trims
from seqframe.plans import fixtures
from seqframe.plans.fixtures import random_letters, random_letters_sql
from seqframe.plans.registry import query
from seqframe.sources import features, reports, sequences, sinks, typed_tables
from seqframe.sources.paths import shared_folder, spread
from seqframe.streaming import reads as streams

table, reads, refs = fixtures.table, fixtures.reads, fixtures.refs
RF, RD = ("fx_refs",), ("fx_reads",)


def lines(df, purpose, *columns, per_file=None):
    """A text file of one column made of several, and its path; with per_file in compressed files of so many rows, as each of these is read by one task."""
    path = shared_folder(df.sparkSession, purpose)
    writer = df.select(F.concat(*[F.lit(c) if isinstance(c, str) else c for c in columns]).alias("value")).write
    (writer.option("maxRecordsPerFile", per_file).option("compression", "gzip") if per_file else writer).text(path)
    return path


# ------------------------------------------------------------ readers


@query("s03_genbank", "accession:s version:n organism:s lineage:s definition:s", "select 'AC' || cast(p_partkey as varchar) as accession, 1 + p_size % 4 as version, p_type as organism, 'Life; ' || p_brand as lineage, p_name || ' part two.' as definition from part")
def _s03(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    path = lines(p, "genbank", "LOCUS       L", key, "   20 bp\nDEFINITION  ", F.col("p_name"), "\n            part two.\nACCESSION   AC", key, "\nVERSION     AC", key, ".", (1 + F.col("p_size") % 4).cast("string"), "  GI:", key, "\nSOURCE      x\n  ORGANISM  ", F.col("p_type"), "\n            Life;\n            ", F.col("p_brand"), ".\nREFERENCE   1\n//")
    return sequences.read_genbank(spark, path)


@query("s04_est", "gi:s organism:s", "select cast(p_partkey as varchar) as gi, p_type as organism from part")
def _s04(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return sequences.read_est(spark, lines(p, "est", "IDENTIFIERS\n\nGenBank gi:     ", F.col("p_partkey").cast("string"), "\nOrganism:      ", F.col("p_type"), "\n||"))


@query("s06_hits_outfmt11", "qseqid:s sseqid:s length:n bitscore:d", "select query as qseqid, target as sseqid, length, score as bitscore from fx_hits", ("fx_hits",))
def _s06(spark, sf_dir):
    h = fixtures.hits(spark, sf_dir)
    path = shared_folder(spark, "hits11")
    h.select("query", "target", "identity", F.lit(300), F.lit(500), "length", "qstart", "qend", "tstart", "tend", "score").write.csv(path, sep="\t")
    return reports.read_hits_outfmt11(spark, path)


def report(spark, sf_dir):
    """A search report of one query a line item, with two segments of its target."""
    d = table(spark, sf_dir, "lineitem")
    t = lambda c: F.col(c).cast("string")
    n = (F.floor("l_quantity") + 10).cast("int").cast("string")
    segment = lambda score, e, first: [f"\n\n Score = ", score, f" bits (99), Expect = {e}\n Identities = ", t("l_linenumber"), "/", n, " (50%), Positives = 9/", n, " (66%), Gaps = 2/60 (3%)\n\nQuery: ", first, " ACGT 44\nSbjct: 11 ACGT 14\n\nQuery: 45 AC 46\nSbjct: 15 AC 16"]  # noqa: E731, F541
    return lines(d, "report", "Query= q", t("l_orderkey"), "_", t("l_linenumber"), " some\n         (120 letters)\n\n>gi|", t("l_partkey"), "|x title\n          Length = ", t("l_suppkey"), *segment(t("l_linenumber"), "2e-10", t("l_suppkey")), *segment(F.lit("5.5"), "e-120", F.lit("7")), per_file=200_000)


_Q = "'q' || cast(l_orderkey as varchar) || '_' || cast(l_linenumber as varchar)"


@query("s07_protein_report", "query:s target:s tlen:n score:d expect:d match_len:n identical:n", f"select {_Q} as query, 'gi|' || cast(l_partkey as varchar) || '|x' as target, l_suppkey as tlen, l_linenumber as score, 2e-10 as expect, floor(l_quantity) + 10 as match_len, l_linenumber as identical from lineitem")
def _s07(spark, sf_dir):
    return reports.parse_hit_report(spark, report(spark, sf_dir))


@query("s08_translated_report", "query:s score:d expect:d qbegin:n qend:n tbegin:n tend:n", f"select {_Q} as query, unnest([cast(l_linenumber as double), 5.5]) as score, unnest([2e-10, 0.0]) as expect, unnest([cast(l_suppkey as bigint), 7]) as qbegin, 46 as qend, 11 as tbegin, 16 as tend from lineitem")
def _s08(spark, sf_dir):
    return reports.parse_hit_report(spark, report(spark, sf_dir), "translated")


@query("s09_segment_report", "target:s n:n", "select 'nr:' || cast(l_partkey as varchar) as target, 2 * count(*) as n from lineitem group by l_partkey")
def _s09(spark, sf_dir):
    return reports.parse_hit_report(spark, report(spark, sf_dir), "segments").groupBy("target").agg(F.count("*").alias("n"))


@query("s10_search_report", "query:s target:s qlen:n tlen:n score:n bits:d identity:d qbegin:n tend:n", "select 'q' || cast(l_orderkey as varchar) as query, 't' || cast(l_partkey as varchar) as target, 120 as qlen, l_suppkey as tlen, l_linenumber as score, 33.5 as bits, 50.5 as identity, l_linenumber as qbegin, l_suppkey as tend from lineitem")
def _s10(spark, sf_dir):
    t = lambda c: F.col(c).cast("string")
    path = lines(table(spark, sf_dir, "lineitem"), "search", ">>>q", t("l_orderkey"), ", 120 aa\n>>t", t("l_partkey"), " x (", t("l_suppkey"), " aa)\n initn: 1 opt: ", t("l_linenumber"), " Z-score: 9 bits: 33.5 E(10): 1e-9\n 50.5% identity in 40 aa overlap (", t("l_linenumber"), "-40:3-", t("l_suppkey"), ")\n>>q", t("l_orderkey"), " self (120 aa)\n opt: 1 bits: 1 E(): 0\n 100.0% identity in 9 aa overlap (1-9:1-9)")
    return reports.parse_search_report(spark, path)


@query("s11_motif_report", "name:s strand:s begin:n end_pos:n score:d match:s", "select ref_id as name, case when length(title) % 2 = 0 then 'FW' else 'RC' end as strand, length(title) as begin, length(title) + 7 as end_pos, 7.25 as score, substr(seq, 1, 8) as match from fx_refs", RF)
def _s11(spark, sf_dir):
    n = F.length("title")
    path = lines(refs(spark, sf_dir), "motif", ">", F.col("ref_id"), " x\n", F.when(n % 2 == 0, "FW").otherwise("RC"), "  1 ", n.cast("string"), "..", (n + 7).cast("string"), " 7.25\n", F.substring("seq", 1, 8))
    return reports.parse_motif_report(spark, path).withColumnRenamed("end", "end_pos")


@query("s16_gene_prediction", "sequence:s gene:n type:s strand:s begin:n end_pos:n", "select 's' || cast(l_orderkey as varchar) as sequence, 1 + l_linenumber as gene, 'Init' as type, '-' as strand, least(l_suppkey, l_partkey) as begin, greatest(l_suppkey, l_partkey) as end_pos from lineitem")
def _s16(spark, sf_dir):
    t = lambda c: F.col(c).cast("string")
    path = lines(table(spark, sf_dir, "lineitem"), "genes", "Sequence s", t("l_orderkey"), " 900 bp\nhead\n ", (1 + F.col("l_linenumber")).cast("string"), ".01 Init - ", t("l_suppkey"), " ", t("l_partkey"), " 99 1 2 9.1")
    return reports.parse_gene_prediction(spark, path).withColumnRenamed("end", "end_pos")


@query("s17_enzymes", "name:s site:s type:s", "select 'E' || cast(p_partkey as varchar) as name, substr(seq, 1, 6) as site, 'II' as type from part join fx_refs on ref_id = 'p' || cast(p_partkey as varchar)", RF)
def _s17(spark, sf_dir):
    r = refs(spark, sf_dir)
    body = r.select(F.concat(F.lit("E"), F.substring("ref_id", 2, 20), F.lit("  "), F.substring("seq", 1, 2), F.lit("^"), F.substring("seq", 3, 4)).alias("value"), F.lit(1).alias("o"))
    head = spark.createDataFrame([("TYPE II ENZYMES", 0)], "value string, o int")
    path = shared_folder(spark, "enzymes")
    head.unionByName(body).coalesce(1).sortWithinPartitions("o").select("value").write.text(path)
    return features.read_enzymes(spark, path)


@query("s19_mothur_clusters", "cluster_id:s seq_id:s", "select 'cl' || cast(k as varchar) as cluster_id, seq_id from (select cluster_id, seq_id, dense_rank() over (order by cluster_id) - 1 as k from fx_clusters) t", ("fx_clusters",))
def _s19(spark, sf_dir):
    c = fixtures.view(spark, sf_dir, "fx_clusters").groupBy("cluster_id").agg(F.array_join(F.array_sort(F.collect_list("seq_id")), ",").alias("l"))
    row = c.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cluster_id", "l"))), lambda x: x["l"]), "\t").alias("v"), F.count("*").cast("string").alias("n"))
    rows = row.select(F.concat(F.lit("0.01\t1\tx"), F.lit("\n0.03\t"), "n", F.lit("\t"), "v", F.lit("\n0.9\t1\ty")).alias("value"))
    path = shared_folder(spark, "mothur")
    rows.write.text(path)
    return sequences.read_clusters(spark, path, "mothur", 0.5)


@query("s22_assembly_info", "key:s value:s n:n", "select 'Num. reads' as key, cast(l_suppkey as varchar) as value, count(*) as n from lineitem group by l_suppkey")
def _s22(spark, sf_dir):
    path = shared_folder(spark, "info")
    # a line a row: no report stands whole in one row or one task
    table(spark, sf_dir, "lineitem").select(F.concat(F.lit("Num. reads: "), F.col("l_suppkey").cast("string")).alias("value")).write.text(path)
    return reports.read_assembly_info(spark, path).groupBy("key", "value").agg(F.count("*").alias("n"))


@query("s23_contig_stats", "name:s length:n", "select ref_id as name, length(title) as length from fx_refs", RF)
def _s23(spark, sf_dir):
    path = shared_folder(spark, "contigs")
    refs(spark, sf_dir).select(F.col("ref_id").alias("name"), F.length("title").alias("length")).write.csv(path, sep="\t", header=True)
    return reports.read_contig_stats(spark, path)


@query("s23_quality_blocks", "seq_id:s total:n n:n", "select 'x' || cast(l_orderkey as varchar) || '_' || cast(l_linenumber as varchar) as seq_id, l_suppkey + 2 * l_linenumber as total, 3 as n from lineitem")
def _s23b(spark, sf_dir):
    t = lambda c: F.col(c).cast("string")
    path = lines(table(spark, sf_dir, "lineitem"), "quals", ">x", t("l_orderkey"), "_", t("l_linenumber"), "\n", t("l_suppkey"), " ", t("l_linenumber"), "\n", t("l_linenumber"))
    return reports.read_quality_blocks(spark, path).select("seq_id", F.aggregate("qual", F.lit(0), lambda a, x: a + x).alias("total"), F.size("qual").alias("n"))


@query("s23_alignment_text", "pair:s query_text:s target_text:s identity:d", "select ref_id || ' x' as pair, seq as query_text, reverse(seq) as target_text, 0.75 as identity from fx_refs", RF)
def _s24(spark, sf_dir):
    row = lambda tag, s: [f"{tag}\t", F.substring(s, 1, 30), "\n"]
    rest = lambda tag, s: [f"{tag}\t", F.substring(s, 31, 99), "\n"]
    back = F.reverse("seq")
    path = lines(refs(spark, sf_dir), "alignments", "identity = 0.75\n====\n", F.col("ref_id"), " x\n", *row("query", F.col("seq")), *row("target", back), *rest("query", F.col("seq")), *rest("target", back), "//")
    return reports.parse_alignment_text(spark, path)


@query("s24_global_similarity", "name1:s length1:n name2:s length2:n percent:d", "select 'a' || cast(r_regionkey as varchar) as name1, 10 + r_regionkey as length1, 'b' as name2, 20 as length2, 61.5 as percent from region")
def _s24g(spark, sf_dir):
    # a report is a file of its own: one row a partition
    r = table(spark, sf_dir, "region")
    path = shared_folder(spark, "similarity")
    k = F.col("r_regionkey").cast("string")
    r.select(F.concat(F.lit("a"), k, F.lit(" "), (10 + F.col("r_regionkey")).cast("string"), F.lit(" aa vs. b 20 aa\n 61.5% identity in 9 aa")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return reports.parse_global_similarity(spark, path)


@query("s25_sequence_headers", "gi:s accession:s title:s species:s n:n", "select cast(p_partkey as varchar) as gi, 'XP_' || cast(p_partkey as varchar) as accession, p_name || ' protein' as title, 'Homo sapiens' as species, length(seq) as n from part join fx_refs on ref_id = 'p' || cast(p_partkey as varchar)", RF)
def _s25(spark, sf_dir):
    k = F.substring("ref_id", 2, 20)
    d = refs(spark, sf_dir).select(F.concat(F.lit("gi|"), k, F.lit("|ref|XP_"), k, F.lit("|")).alias("seq_id"), F.concat("title", F.lit(" protein [Homo sapiens]")).alias("title"), "seq")
    return sequences.read_sequence_headers(d).withColumn("n", F.length("seq"))


@query("s25_contig_headers", "contig_id:n seq:s", "select cast(substr(ref_id, 2) as bigint) as contig_id, seq from fx_refs", RF)
def _s25c(spark, sf_dir):
    r = refs(spark, sf_dir)
    other = r.select(F.concat(F.lit("scaffold_"), F.substring("ref_id", 2, 20)).alias("seq_id"), "seq")
    return sequences.read_contig_headers(r.select(F.concat(F.lit("contig_1."), F.substring("ref_id", 2, 20)).alias("seq_id"), "seq").unionByName(other))


@query("s25_protein_headers", "protein_id:n title:s seq:s", "select cast(substr(ref_id, 2) as bigint) as protein_id, title || ' protein' as title, seq from fx_refs", RF)
def _s25p(spark, sf_dir):
    k = F.lpad(F.substring("ref_id", 2, 20), 9, "0")
    note = F.when(F.length("seq") % 2 == 0, F.concat(F.lit(" (translation) ("), F.length("seq").cast("string"), F.lit(" aa)"))).otherwise("")
    d = refs(spark, sf_dir).select(F.concat(F.lit("ABC1_"), k).alias("seq_id"), F.concat(F.lit("| Homo sapiens "), "title", F.lit(" protein"), note).alias("title"), "seq")
    return sequences.read_protein_headers(d, "Homo sapiens")


@query("s26_order_over_files", "seq_id:s place:n", "select ref_id as seq_id, row_number() over (order by cast(substr(ref_id, 2) as bigint) % 3, cast(substr(ref_id, 2) as bigint)) as place from fx_refs", RF)
def _s26(spark, sf_dir):
    from seqframe.operators.select import places

    path = shared_folder(spark, "files")
    n = F.substring("ref_id", 2, 20).cast("long")
    refs(spark, sf_dir).select(n.alias("n"), (n % 3).alias("part"), F.concat(F.lit(">"), "ref_id", F.lit("\n"), "seq").alias("value")).repartition(3, "part").select("part", "value").write.partitionBy("part").text(path)
    back = sequences.read_fasta(spark, path).select("seq_id", F.regexp_extract("src", r"part=(\d+)", 1).alias("src"), F.substring("seq_id", 2, 20).cast("long").alias("ord"))
    return places(back, ("src", "ord"), "place")


@query("s27_mate_files", "stem:s mate:n", "select 'x' || cast(r_regionkey as varchar) as stem, unnest([1, 2]) as mate from region")
def _s27(spark, sf_dir):
    path = shared_folder(spark, "mates")
    r = table(spark, sf_dir, "region").select(F.explode(F.array(*[F.concat(F.lit("x"), F.col("r_regionkey").cast("string"), F.lit(f"_{k}")) for k in (1, 2)])).alias("name"))
    # files whose names Spark doesn't choose are made by its own file system layer, one small file each
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for row in r.collect():  # two names a region
        where = jvm.org.apache.hadoop.fs.Path(f"{path}/{row['name']}.fastq")
        out = where.getFileSystem(conf).create(where)
        out.writeBytes("@a\nA\n+\nI\n")
        out.close()
    return sequences.read_mate_files(spark, path)


@query("s28_two_line_fasta", "seq_id:s seq:s", "select ref_id as seq_id, seq from fx_refs", RF)
def _s28(spark, sf_dir):
    return sequences.read_two_line_fasta(spark, lines(refs(spark, sf_dir), "two", ">", F.col("ref_id"), "\n", F.col("seq")))


# ------------------------------------------------------------ sinks


def fasta(df):
    return df.withColumnRenamed("ref_id", "seq_id")


@query("k04_split_by_records", "seq_id:s seq:s small:b", "select ref_id as seq_id, seq, true as small from fx_refs", RF)
def _k04(spark, sf_dir):
    path = shared_folder(spark, "split")
    sinks.write_split_by_records(fasta(refs(spark, sf_dir)), path, 100)
    back = sequences.read_fasta(spark, path)
    sizes = back.groupBy("src").agg((F.count("*") <= 100).alias("small"))
    return back.join(sizes, "src")


@query("k05_split_into", "n_files:n n_records:n", "select 7 as n_files, count(*) as n_records from fx_refs", RF)
def _k05(spark, sf_dir):
    path = shared_folder(spark, "pieces")
    sinks.write_split_into(fasta(refs(spark, sf_dir)), path, 7)
    return sequences.read_fasta(spark, path).agg(F.count_distinct("src").alias("n_files"), F.count("*").alias("n_records"))


@query("k06_one_file_each", "bucket:n name:s seq:s", "select (r_regionkey) // 2 as bucket, 'n' || cast(r_regionkey as varchar) as name, upper(substr(r_name, 1, 2)) as seq from region")
def _k06(spark, sf_dir):
    path = shared_folder(spark, "each")
    r = table(spark, sf_dir, "region").select(F.concat(F.lit("n"), F.col("r_regionkey").cast("string")).alias("seq_id"), F.upper(F.substring("r_name", 1, 2)).alias("seq"), F.lit("a").alias("src"), F.col("r_regionkey").alias("ord"))
    sinks.write_one_file_each(r, path, 2)
    return sequences.read_fasta(spark, path).select(F.regexp_extract("src", r"bucket=(\d+)", 1).cast("int").alias("bucket"), F.regexp_extract("src", r"name=(\w+)", 1).alias("name"), "seq")


@query("k07_by_bases", "src:s n:n", "select src, count(*) as n from fx_reads group by src", RD)
def _k07(spark, sf_dir):
    path = shared_folder(spark, "bases")
    sinks.write_by_bases(reads(spark, sf_dir).withColumn("seq_id", F.concat_ws("|", "src", "read_id")), path, 100_000)
    return sequences.read_fasta(spark, path).groupBy(F.substring_index("seq_id", "|", 1).alias("src")).agg(F.count("*").alias("n"))


@query("k08_directories_of_files", "path:s directory:n", "select ref_id as path, (row_number() over (order by ref_id) - 1) // 300 as directory from fx_refs", RF)
def _k08(spark, sf_dir):
    return sinks.directories_of_files(refs(spark, sf_dir).select(F.col("ref_id").alias("path")), 300)


@query("k09_append", "n_records:n n_ids:n", "select 2 * count(*) as n_records, count(*) as n_ids from fx_refs", RF)
def _k09(spark, sf_dir):
    path, r = shared_folder(spark, "append"), fasta(refs(spark, sf_dir))
    sinks.write_fasta(r, path)
    sinks.write_fasta(r, path, mode="append")
    return sequences.read_fasta(spark, path).agg(F.count("*").alias("n_records"), F.count_distinct("seq_id").alias("n_ids"))


# ------------------------------------------------------------ table functions


@query("udtf_kmers", "kmer:s n:n", "select substr(seq, cast(i as int), 8) as kmer, count(*) as n from (select seq, unnest(range(1, cast(length(seq) - 6 as bigint))) as i from fx_refs) t group by 1", RF)
def _kmers(spark, sf_dir):
    tables.register(spark)
    return spark.sql("select k.kmer, count(*) as n from {r} r, lateral kmers(r.seq, 8) k group by k.kmer", r=refs(spark, sf_dir))


@query("udtf_runs", "base:s length:n n:n", "select b as base, len as length, count(*) as n from (select ref_id, b, p - rn as island, count(*) as len from (select ref_id, i as p, substr(seq, cast(i as int), 1) as b, row_number() over (partition by ref_id, substr(seq, cast(i as int), 1) order by i) as rn from (select ref_id, seq, unnest(range(1, cast(length(seq) as bigint) + 1)) as i from fx_refs) x) y group by ref_id, b, p - rn) z group by b, len", RF)
def _runs(spark, sf_dir):
    tables.register(spark)
    return spark.sql("select k.base, k.length, count(*) as n from {r} r, lateral runs(r.seq) k group by k.base, k.length", r=refs(spark, sf_dir))


# ------------------------------------------------------------ streams


def arriving(spark, sf_dir, df):
    """df as a stream of files in the shared folder, and a runner that drains a stream into a table."""
    path = shared_folder(spark, "arriving")
    df.write.parquet(path)

    def drain(stream, mode):
        out = shared_folder(spark, "drained")
        query = stream.writeStream.outputMode(mode).option("checkpointLocation", shared_folder(spark, "stream")).trigger(availableNow=True).foreachBatch(lambda batch, k: batch.write.mode("append").parquet(f"{out}/batch={k}")).start()
        query.awaitTermination()
        return spark.read.parquet(out)

    return streams.stream_table(spark, path, df.schema, 1000), drain


def arrived(df):
    return df.withColumn("arrived", F.timestamp_seconds(F.col("ord") % 7200))


@query("t01_clean_stream", "read_id:s seq:s rc:s gc:n", "select read_id, s as seq, reverse(translate(s, 'ACGT', 'TGCA')) as rc, length(s) - length(translate(s, 'GC', '')) as gc from (select *, regexp_replace(regexp_replace(seq, '^N+', ''), 'N+$', '') as s, list_sum(list_transform(string_split(qual33, ''), lambda c: ascii(c) - 33)) * 1.0 / length(qual33) as q from fx_reads) t where q >= 24 and length(s) >= 30 and length(s) - length(replace(s, 'N', '')) <= 0", RD)
def _t01(spark, sf_dir):
    # filters and trims on a stream, then column functions on what it keeps
    d = reads(spark, sf_dir).select("read_id", "seq", S.decode_quality("qual33").alias("qual"))
    stream, drain = arriving(spark, sf_dir, d)
    kept = streams.cleaned(stream, 30, 24, 0)
    return drain(kept.select("read_id", "seq", S.revcomp("seq").alias("rc"), S.count_of("seq", "GC").alias("gc")), "append")


@query("t02_running_statistics", "n_reads:n n_bases:n gc:d", "select count(*) as n_reads, sum(length(seq)) as n_bases, sum(length(seq) - length(translate(seq, 'GC', ''))) * 1.0 / sum(length(translate(seq, 'N', ''))) as gc from fx_reads group by (ord % 7200) // 3600", RD)
def _t02r(spark, sf_dir):
    d = arrived(reads(spark, sf_dir)).withColumn("qual", S.decode_quality("qual33"))
    stream, drain = arriving(spark, sf_dir, d)
    rows = drain(streams.running_statistics(stream), "update")
    return rows.groupBy("start").agg(F.max_by(F.struct("n_reads", "n_bases", "gc"), "n_reads").alias("r")).select("r.*")


@query("t03_first_wins", "ref_id:s n:n", "select distinct ref_id, 1 as n from fx_reads", RD)
def _t02(spark, sf_dir):
    stream, drain = arriving(spark, sf_dir, arrived(reads(spark, sf_dir)).select("ref_id", "arrived"))
    return drain(streams.first_wins(stream, "ref_id"), "append").groupBy("ref_id").agg(F.count("*").alias("n"))


@query("t04_pick_ids", "read_id:s", "select read_id from fx_reads where src = 'f1'", RD)
def _t03(spark, sf_dir):
    d = reads(spark, sf_dir).select("read_id", "src", "seq")
    stream, drain = arriving(spark, sf_dir, d)
    return drain(streams.pick_ids(stream, d.filter("src = 'f1'")), "append")


@query("t04_match_library", "read_id:s library_id:s", "select r.read_id, l.id as library_id from fx_reads r left join (select substr(seq, 1, 21) as s, min(ref_id) as id from fx_refs group by 1) l on l.s = substr(r.seq, 1, 21)", RD)
def _t04(spark, sf_dir):
    lib = refs(spark, sf_dir).groupBy(F.substring("seq", 1, 21).alias("sequence")).agg(F.min("ref_id").alias("library_id"))
    stream, drain = arriving(spark, sf_dir, reads(spark, sf_dir).select("read_id", "seq"))
    return drain(streams.match_library(stream, lib), "append")


@query("t05_pair_mates", "id1:s n1:n n2:n", "select read_id as id1, length(seq) as n1, length(seq) + 1 as n2 from fx_reads", RD)
def _t05(spark, sf_dir):
    d = arrived(reads(spark, sf_dir)).select("read_id", "seq", "arrived")
    a, drain = arriving(spark, sf_dir, d)
    b, _ = arriving(spark, sf_dir, d.withColumn("seq", F.concat("seq", F.lit("A"))))
    return drain(streams.pair_mates(a, b), "append").filter("id2 is not null").select("id1", F.length("seq1").alias("n1"), F.length("seq2").alias("n2"))


@query("t06_cut_states", "project:n state:n", "select project, case when max(case when cls not in (0, 1, 2) then 1 else 0 end) = 1 or (max(case when cls = 1 then 1 else 0 end) = 1 and max(case when cls = 2 then 1 else 0 end) = 1) then -1 when max(case when cls = 2 then 1 else 0 end) = 1 then 2 when max(case when cls = 1 then 1 else 0 end) = 1 then 1 else 0 end as state from fx_runs group by project", ("fx_runs",))
def _t06(spark, sf_dir):
    stream, drain = arriving(spark, sf_dir, fixtures.view(spark, sf_dir, "fx_runs").select(F.col("project").cast("long").alias("project"), "ord", "cls").coalesce(1))
    return drain(streams.cut_states(stream), "update")


# ------------------------------------------------------------ alignments


LEFT, RIGHT = "ACGTTGCAACGGCTAGCTCG", "CGGATCTTACGGTCAAGCAT"


def baited(spark, sf_dir):
    """A read for each part: the bait's flanks around a number of Ts, every third on the other strand."""
    n = F.col("p_partkey").cast("int")
    seq = F.concat(F.lit("GG" + LEFT), F.repeat(F.lit("T"), (6 + n % 4).cast("int")), F.lit(RIGHT + "AC"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("read_id"), F.when(n % 3 == 0, S.revcomp(seq)).otherwise(seq).alias("seq"))


@query("a30_repeat_counts", "repeats:n n:n mean:d", "select 6 + p_partkey % 4 as repeats, count(*) as n, (select avg(6 + p_partkey % 4) from part) as mean from part group by p_partkey % 4")
def _a30(spark, sf_dir):
    return gaps.repeat_count_table(gaps.repeat_in_bait(baited(spark, sf_dir), LEFT + "T" * 8 + RIGHT, 21, 8, "T"))


@query("c44_repeat_in_bait", "read_id:s strand:s repeats:n", "select cast(p_partkey as varchar) as read_id, case when p_partkey % 3 = 0 then '-' else '+' end as strand, 6 + p_partkey % 4 as repeats from part")
def _c44(spark, sf_dir):
    return gaps.repeat_in_bait(baited(spark, sf_dir), LEFT + "T" * 8 + RIGHT, 21, 8, "T")


@query("a31_count_subsequence", "text:s n:n", "select 'CTCG' || repeat('T', cast(p_partkey % 2 * 2 as int)) || 'ATTAT' || 'CGGA' as text, count(*) as n from part group by 1")
def _a31(spark, sf_dir):
    n = F.col("p_partkey").cast("int")
    d = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("read_id"), F.concat(F.lit(LEFT), F.repeat(F.lit("T"), (n % 2 * 2).cast("int")), F.lit("ATTAT" + RIGHT)).alias("seq"))
    return gaps.count_subsequence(d, LEFT + "TTATTAT" + RIGHT, 17, 31).withColumn("text", F.replace(F.col("text"), F.lit("-"), F.lit("")))


@query("c43_text_under", "read_id:s text:s", "select cast(p_partkey as varchar) as read_id, substr(seq, 11, 10) as text from part join fx_refs on ref_id = 'p' || cast(p_partkey as varchar)", RF)
def _c43(spark, sf_dir):
    r = refs(spark, sf_dir).select(F.substring("ref_id", 2, 20).alias("read_id"), F.col("seq").alias("ref_seq"), F.substring("seq", 6, 50).alias("read_seq"))
    return gaps._edited(align.align_pairs(spread(r), "local").select("read_id", "top", "bottom", "ref_begin"), lambda x: {"text": align.text_under(x["top"], x["bottom"], x["ref_begin"], 10, 19)}, ["text"], "text string").select("read_id", "text")


@query("c40_align_pairs", "ref_id:s score:n identity:d gaplen_read:n ref_begin:n", "select ref_id, 10 * 60 - 29 - 3 * 3 as score, 60.0 / 64 as identity, 4 as gaplen_read, 0 as ref_begin from fx_refs", RF)
def _c40(spark, sf_dir):
    # four letters are missing; the ends are long enough for the gap to pay
    r = refs(spark, sf_dir).select("ref_id", F.col("seq").alias("ref_seq"), F.concat(F.substring("seq", 1, 30), F.substring("seq", 35, 30)).alias("read_seq"))
    return align.align_pairs(spread(r), "global")


@query("c42_correct_gaps", "ref_id:s bottom:s ref_begin:n", "select ref_id, substr(seq, 1, cast(g - 1 as int)) || lower(substr(seq, cast(g as int), 1)) || substr(seq, cast(g + 1 as int)) as bottom, 0 as ref_begin from (select *, 32 - length(regexp_extract(substr(seq, 1, 31), '(A+|C+|G+|T+)$')) as g from fx_refs) t", RF)
def _c42(spark, sf_dir):
    # one letter is missing; of a homopolymer the aligner leaves out the first letter
    r = refs(spark, sf_dir).select("ref_id", F.col("seq").alias("ref_seq"), F.concat(F.substring("seq", 1, 30), F.substring("seq", 32, 40)).alias("read_seq"))
    return gaps.corrected(align.align_pairs(spread(r), "global").drop("ref_seq", "read_seq").withColumn("strand", F.lit("+")))


CHIMERA = "substr(y, 1, 160) || " + " || ".join(f"translate(substr(y, {161 + 12 * k}, 1), 'ACGT', 'CGTA') || substr(y, {162 + 12 * k}, {11 if k < 12 else 15})" for k in range(13))


@query("c46_merge_decision", "read_id:s ref_id:s kind:s seq:s", f"""
with long as (select ref_id, seq, {random_letters_sql('ref_id', 10)} as y, {random_letters_sql("'a' || ref_id", 2)} as tail from fx_refs),
     planted as (select *, {CHIMERA} as chimera from long)
select ref_id as read_id, ref_id, 'merged' as kind, seq from planted
union all select ref_id || 'x', ref_id, unnest(['merged', 'scrap']), unnest([tail || 'N' || seq, tail || 'N']) from planted
union all select ref_id || 'y', ref_id || 'l', unnest(['merged', 'scrap']), unnest([substr(chimera, 1, 172), substr(chimera, 173)]) from planted""", RF)
def _c46(spark, sf_dir):
    # the reference itself; with a long head; one that is the same over half of a longer reference and differs in every twelfth letter of the rest
    r = refs(spark, sf_dir).withColumn("a", F.concat(F.lit("a"), "ref_id")).select("ref_id", "seq", random_letters("ref_id", 10).alias("y"), random_letters("a", 2).alias("tail"))
    changed = [x for k in range(13) for x in (F.translate(F.substring("y", 161 + 12 * k, 1), "ACGT", "CGTA"), F.substring("y", 162 + 12 * k, 11 if k < 12 else 15))]
    made = [("", "", F.col("seq"), F.col("seq")), ("", "x", F.col("seq"), F.concat("tail", F.lit("N"), "seq")), ("l", "y", F.col("y"), F.concat(F.substring("y", 1, 160), *changed))]
    rows = r.select(F.explode(F.array(*[F.struct(F.concat("ref_id", F.lit(a)).alias("ref_id"), F.concat("ref_id", F.lit(b)).alias("read_id"), c.alias("ref_seq"), d.alias("read_seq"), F.lit("+").alias("strand")) for a, b, c, d in made])).alias("p")).select("p.*")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    aligned = align.align_pairs(rows.repartition(n, "read_id"), "local", align.SCORES["consensus"]).drop("ref_seq", "read_seq")
    return gaps.merge_decision(aligned, rows.select("read_id", F.col("read_seq").alias("seq")), 0.95, 40)


@query("c47_stems", "read_id:s first:s second:s stem_length:n stem_identity:d", "select ref_id as read_id, substr(seq, 1, 24) as first, cast(null as varchar) as second, 24 as stem_length, 1.0 as stem_identity from fx_refs where strpos(substr(seq, 1, 24), 'CTCGAG') = 0 and strpos(reverse(translate(substr(seq, 1, 24), 'ACGT', 'TGCA')), 'CTCGAG') = 0", RF)
def _c47(spark, sf_dir):
    arm = F.substring("seq", 1, 24)
    d = refs(spark, sf_dir).filter(~F.contains(arm, F.lit("CTCGAG"))).select(F.col("ref_id").alias("read_id"), F.concat(arm, F.lit("CTCGAG"), S.revcomp(arm)).alias("insert"))
    return gaps.stems(clusters.split_stem(d))


@query("c48_stem_consensus", "read_id:s first:s second:s", "select ref_id as read_id, substr(seq, 1, 11) || 'A' || substr(seq, 13, 12) as first, substr(seq, 1, 11) || 'C' || substr(seq, 13, 12) as second from fx_refs", RF)
def _c48(spark, sf_dir):
    arm = lambda c: F.concat(F.substring("seq", 1, 11), F.lit(c), F.substring("seq", 13, 12))
    d = refs(spark, sf_dir).select(F.col("ref_id").alias("read_id"), arm("A").alias("top_seq"), arm("C").alias("bottom_seq"))
    return gaps.stems(d)


@query("x02_genotype_paired", "pair:s n:n", "select case when (ord // 100) % 2 = 1 then '-+' else '+-' end as pair, count(*) as n from fx_reads where ref_id = (select ref_id from fx_reads group by ref_id order by count(*) desc, ref_id limit 1) group by 1", RD)
def _x02(spark, sf_dir):
    d = reads(spark, sf_dir).select("read_id", "seq")
    return pileup.genotype_paired(d, d.withColumn("seq", S.revcomp("seq")), refs(spark, sf_dir).select("ref_id", "seq"), [1, 3], identity=0.9, length=23)["mates"]


@query("a19_genotype_aa", "ref_id:s aa:s n:n")
def _a19(spark, sf_dir):
    return pileup.genotype(reads(spark, sf_dir).select("read_id", "seq"), refs(spark, sf_dir).select("ref_id", "seq"), [1, 3])["genotypes_aa"]


def own_alignments(spark, sf_dir, quality=False):
    """Every read with its own reference, as planted, aligned."""
    d = reads(spark, sf_dir)
    turned = F.floor(F.col("ord") / 100) % 2 == 1
    qual = S.decode_quality("qual33")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))  # the alignments are the work, which small shuffles would put in one task
    pairs = d.repartition(n, "ref_id").join(refs(spark, sf_dir).select("ref_id", F.col("seq").alias("ref_seq")), "ref_id").select("read_id", "ref_id", "ref_seq", F.when(turned, S.revcomp("seq")).otherwise(F.col("seq")).alias("read_seq"), *([F.when(turned, F.reverse(qual)).otherwise(qual).alias("qual")] if quality else []))
    return align.align_pairs(pairs, "local").drop("ref_seq", "read_seq")


@query("a20_position_table", "ref_id:s pos:n base:s n:n fraction:d rank:n", "select ref_id, pos, base, n, n * 1.0 / sum(n) over (partition by ref_id, pos) as fraction, row_number() over (partition by ref_id, pos order by n desc, base) as rank from (select ref_id, pos, base, count(*) as n from fx_cols group by 1, 2, 3) t", ("fx_cols",))
def _a20(spark, sf_dir):
    return pileup.position_table(pileup.pileup(pileup.alignment_columns(own_alignments(spark, sf_dir))))


@query("a20_quality_table", "ref_id:s pos:n mean:d n:n", "select ref_id, pos, avg(q) as mean, count(*) as n from fx_cols group by 1, 2", ("fx_cols",))
def _a20q(spark, sf_dir):
    return pileup.quality_table(pileup.alignment_columns(own_alignments(spark, sf_dir, quality=True), quality="qual"))


@query("k13_coverage_outputs", "ref_id:s pos:n cons:n nogap:n total:n", "select ref_id, pos, max(n) as cons, sum(n) as nogap, sum(n) as total from (select ref_id, pos, base, count(*) as n from fx_cols group by 1, 2, 3) t group by 1, 2", ("fx_cols",))
def _k13(spark, sf_dir):
    return sinks.coverage_outputs(own_alignments(spark, sf_dir, quality=True), "qual")["vertcov"]


@query("c41_alignment_columns", "read_id:s n:n bases:s", "select read_id, count(*) as n, string_agg(base, '' order by pos) as bases from fx_cols group by read_id", ("fx_cols",))
def _c41(spark, sf_dir):
    c = pileup.alignment_columns(own_alignments(spark, sf_dir))
    return c.groupBy("read_id").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "base"))), lambda x: x["base"]), "").alias("bases"))


@query("x05_trim_flanks", "class:s n:n", "select 'both' as class, count(*) as n from part where p_partkey % 3 <> 0 union all select 'left' as class, count(*) as n from part where p_partkey % 3 = 0")
def _x05(spark, sf_dir):
    n = F.col("p_partkey").cast("int")
    body = F.translate(F.md5(F.col("p_partkey").cast("string")), "0123456789abcdef", "AAAAAAAATTTTTTTT")
    d = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("read_id"), F.concat(F.lit("GGGCGGGGCGGG"), body, F.when(n % 3 == 0, "").otherwise("CCCACCCCACCC")).alias("seq"))
    return align.trim_flanks(d, "GGGCGGGGCGGG", "CCCACCCCACCC")["classes"]


@query("x12_assembly_qc", "input:s strand:s identity:d rotated:n", "select ref_id as input, '+' as strand, 1.0 as identity, 0 as rotated from fx_refs union all select ref_id || 'u' as input, '-' as strand, 1.0 as identity, 20 as rotated from fx_refs", RF)
def _x12(spark, sf_dir):
    r = refs(spark, sf_dir)
    cut = r.select(F.col("ref_id").alias("input"), "seq", F.lit(True).alias("cut"))
    # an uncut assembly is the ring opened elsewhere, here on the other strand
    ring = S.revcomp(F.concat(F.substring("seq", 21, 44), F.substring("seq", 1, 20)))
    uncut = r.select(F.concat("ref_id", F.lit("u")).alias("input"), ring.alias("seq"), F.lit(False).alias("cut"))
    known = r.select(F.col("ref_id").alias("input"), F.col("seq").alias("ref_seq")).unionByName(r.select(F.concat("ref_id", F.lit("u")).alias("input"), F.col("seq").alias("ref_seq")))
    return assembly.assembly_qc(cut.unionByName(uncut), known)


@query("x13_load_annotation", "transcript_id:s gene_id:s n_exons:n gene_start:n n_transcripts:n", "select transcript_id, t.gene_id, n_exons, gene_start, n_transcripts from (select genomicid, strand, transcript_id, gene_id, count(*) as n_exons from fx_exons group by 1, 2, 3, 4) t join (select gene_id, min(start_pos) as gene_start, count(distinct transcript_id) as n_transcripts from fx_exons group by gene_id) g on t.gene_id = g.gene_id", ("fx_exons",))
def _x13(spark, sf_dir):
    path = shared_folder(spark, "annotation")
    e = fixtures.exons(spark, sf_dir)
    attrs = F.concat(F.lit("Parent="), "transcript_id", F.lit(";gene="), "gene_id")
    e.select(F.concat_ws("\t", "genomicid", F.lit("x"), F.lit("exon"), F.col("start_pos").cast("string"), F.col("end_pos").cast("string"), F.lit("."), "strand", F.lit("."), attrs).alias("value")).write.text(path)
    return annotation.load_annotation(features.read_gff3(spark, path))["transcripts"]


def annotation_file(spark, sf_dir, odd=False):
    """Features of a GFF3 file: sequences, genes (a thousand letters each), transcripts and exons.

    With odd, one gene in seven is missing, the exons of one transcript in ten come twice under the same number, and strands of
    genes whose number divides by eleven are two letters long.
    """
    path = shared_folder(spark, "gff")
    e = fixtures.exons(spark, sf_dir)
    g = F.substring("gene_id", 2, 9).cast("int")
    line = lambda kind, a, b, attrs, strand="strand": F.concat_ws("\t", "genomicid", F.lit("x"), F.lit(kind), a.cast("string"), b.cast("string"), F.lit("."), strand, F.lit("."), attrs).alias("value")
    rows = e.select(line("region", F.lit(1), F.lit(10_000_000), F.lit("organism=x;chromosome=1"), F.lit("+"))).distinct()
    rows = rows.unionByName(e.filter(g % 7 > 0 if odd else F.lit(True)).select(line("gene", (g + 1) * 1000, (g + 1) * 1000 + 999, F.concat(F.lit("ID="), "gene_id"), F.when((g % 11 == 0) & F.lit(odd), "++").otherwise(F.col("strand")))).distinct())
    rows = rows.unionByName(e.select(line("mRNA", F.lit(1), F.lit(2), F.concat(F.lit("ID="), "transcript_id", F.lit(";Parent="), "gene_id"))).distinct())
    rows.unionByName(e.select(line("exon", F.col("start_pos"), F.col("end_pos"), F.concat(F.lit("Parent="), "transcript_id")))).write.text(path)
    return features.read_gff3(spark, path)


@query("k12_load_tables", "table_name:s n:n", "select 'source' as table_name, count(distinct genomicid) as n from fx_exons union all select 'gene', count(distinct gene_id) from fx_exons union all select 'transcript', count(distinct transcript_id) from fx_exons union all select 'exon', count(*) from fx_exons", ("fx_exons",))
def _k12_load(spark, sf_dir):
    target = shared_folder(spark, "annotation")
    made = annotation.typed_annotation(annotation_file(spark, sf_dir))
    typed_tables.load_tables({k: made[k] for k in ("source", "gene", "transcript", "exon")}, target)
    counts = [typed_tables.stored_table(spark, target, k).agg(F.count("*").alias("n")).select(F.lit(k).alias("table_name"), "n") for k in ("source", "gene", "transcript", "exon")]
    return functools.reduce(lambda a, b: a.unionByName(b), counts)


@query("k12_load_problems", "table_name:s column_name:s problem:s n:n", """
    select 'gene' as table_name, 'strand' as column_name, 'too long' as problem, count(distinct gene_id) as n from fx_exons where cast(substr(gene_id, 2) as int) % 7 > 0 and cast(substr(gene_id, 2) as int) % 11 = 0
    union all select 'transcript', 'geneid', 'not in gene', count(distinct transcript_id) from fx_exons where cast(substr(gene_id, 2) as int) % 7 = 0
    union all select 'exon', 'transcriptid,exon_number', 'repeated key', 2 * count(*) from fx_exons where cast(substr(transcript_id, 2) as int) % 10 = 0""", ("fx_exons",))  # fmt: skip
def _k12_problems(spark, sf_dir):
    made = annotation.typed_annotation(annotation_file(spark, sf_dir, odd=True))
    twice = made["exon"].unionByName(made["exon"].filter(F.substring("transcriptid", 2, 12).cast("long") % 10 == 0))
    return typed_tables.problems({k: made[k] for k in ("source", "gene", "transcript")} | {"exon": twice})


@query("j24_integrate_protein", "gi:n proteinid:s geneid:s sequence:s", "select l_orderkey * 10 + l_linenumber as gi, 'n' || p_partkey as proteinid, p_brand as geneid, l_returnflag as sequence from part join lineitem on l_partkey = p_partkey")
def _j24_protein(spark, sf_dir):
    raw = fixtures.table(spark, sf_dir, "part").select(F.concat(F.lit("n"), "p_partkey").alias("proteinid"), F.col("p_brand").alias("geneid"), F.col("p_name").alias("product"), F.lit("").alias("attribute"))
    seqs = fixtures.table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("gi"), F.concat(F.lit("n"), "l_partkey").alias("proteinid"), F.col("l_returnflag").alias("sequence"))
    return annotation.integrate_protein(raw, seqs)


@query("j24_integrate_qc", "result_id:n identity:d alnlength:n", "select o_orderkey as result_id, l_discount as identity, l_quantity as alnlength from lineitem join orders on l_orderkey % 1000 = o_orderkey % 1000 and l_linenumber = o_orderkey % 7 + 1 and l_orderkey = o_orderkey")
def _j24_qc(spark, sf_dir):
    key = lambda c: F.concat_ws("/", F.col(c) % 1000, c).alias("input")
    raw = fixtures.table(spark, sf_dir, "lineitem").select(key("l_orderkey"), F.col("l_linenumber").cast("long").alias("fraction"), F.col("l_discount").alias("identity"), F.col("l_quantity").cast("long").alias("alnlength"))
    return annotation.integrate_qc(raw, fixtures.table(spark, sf_dir, "orders").select(key("o_orderkey"), (F.col("o_orderkey") % 7 + 1).cast("long").alias("fraction"), F.col("o_orderkey").alias("id")))


# ------------------------------------------------------------ trims


def tailed(spark, sf_dir, head, tail):
    return refs(spark, sf_dir).select("ref_id", F.concat(F.lit(head), "seq", F.lit(tail)).alias("seq"))


@query("c24_complexity_trim", "ref_id:s code:n shorter:b", "select ref_id, 2 as code, true as shorter from fx_refs", RF)
def _c24(spark, sf_dir):
    cut = trims.complexity_trim(tailed(spark, sf_dir, "", "A" * 60))
    return cut.select("ref_id", "code", (F.length("seq") < 90).alias("shorter"))


@query("c25_remove_poly_a", "ref_id:s seq:s", "select ref_id, seq || 'GCGCGCGCGCGC' as seq from fx_refs", RF)
def _c25(spark, sf_dir):
    return trims.remove_poly_a(tailed(spark, sf_dir, "", "GC" * 6 + "A" * 40))


@query("c25_remove_poly_t", "ref_id:s seq:s", "select ref_id, 'GCGCGCGCGCGC' || seq as seq from fx_refs", RF)
def _c25t(spark, sf_dir):
    return trims.remove_poly_t(tailed(spark, sf_dir, "T" * 40 + "GC" * 6, ""))


# No two As stand together in the first letters, so all peaks are the planted ones: a tail with two letters after it; a peak before such
# a tail; two peaks, the last before simple letters; an early peak, which stays.
SPARSE, AFTER = "replace(seq, 'AA', 'AC')", "CGTCCGTCTGCTCGTGCTCTGCTG"
PEAKS = {"a": ("A" * 12 + "CG", 1), "b": ("A" * 20 + AFTER + "A" * 30 + "CG", 0), "c": ("A" * 20 + AFTER + "A" * 30 + "C" * 30, 0), "d": ("A" * 20 + AFTER * 6, 2)}
PEAK_ROWS = " union all ".join(f"select ref_id || '{k}' as ref_id, {SPARSE} || 'G' || '{t}' as text, {SPARSE} || 'G' as body, {end} as stays from fx_refs" for k, (t, end) in PEAKS.items())


@query("c26_short_read_poly_a", "ref_id:s seq:s", f"select ref_id, case when stays = 2 then text else body end as seq from ({PEAK_ROWS}) t", RF)
def _c26(spark, sf_dir):
    rows = F.array(*[F.struct(F.concat("ref_id", F.lit(k)).alias("ref_id"), F.concat(F.expr(SPARSE), F.lit("G" + t)).alias("seq")) for k, (t, _) in PEAKS.items()])
    return trims.short_read_poly_a(refs(spark, sf_dir).select(F.explode(rows).alias("r")).select("r.*"))


@query("c18_trim_n_halves", "ref_id:s seq:s", "select ref_id, seq from fx_refs", RF)
def _c18(spark, sf_dir):
    return tailed(spark, sf_dir, "NACGNN", "NNTTN").select("ref_id", S.trim_n_halves("seq").alias("seq"))


@query("c18_trim_n_by_distance", "ref_id:s seq:s", "select ref_id, seq from fx_refs", RF)
def _c18b(spark, sf_dir):
    return tailed(spark, sf_dir, "ACGNAAN", "NNCTN").select("ref_id", S.trim_n_by_distance("seq").alias("seq"))


@query("x07_clean_est", "ref_id:s seq:s", "select ref_id, 'GC' || seq || 'GC' as seq from fx_refs", RF)
def _x07(spark, sf_dir):
    return trims.clean_est(tailed(spark, sf_dir, "CTTTTTTTTTTTTTTGC", "GC" + "A" * 40))


@query("x07_raw_lengths", "length:n n:n", "select length(p_name) as length, count(*) as n from part group by 1")
def _x07_lengths(spark, sf_dir):
    return trims.clean_est_report(table(spark, sf_dir, "part").select(F.col("p_name").alias("seq")))["raw_lengths"]


@query("x08_clean_vector_est", "ref_id:s seq:s", f"select ref_id, {SPARSE} as seq from fx_refs", RF)
def _x08(spark, sf_dir):
    return trims.clean_vector_est(tailed(spark, sf_dir, "ACGTXXXX", "XXXXACG").withColumn("seq", F.expr(SPARSE)))
