"""Queries for alignment jobs, pileups, sources and sinks: round trips through files in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqframe.functions import sequence as S
from seqframe.operators import align, clusters, pileup
from seqframe.plans import fixtures
from seqframe.plans.fixtures import random_letters, random_letters_sql
from seqframe.plans.q_functions import _AA
from seqframe.plans.registry import query
from seqframe.sources import fastq, features, reports, sequences, sinks
from seqframe.sources.paths import shared_folder

table, reads, refs = fixtures.table, fixtures.reads, fixtures.refs
ALN, COLS = ("fx_aln",), ("fx_cols",)
R, RR = ("fx_reads",), ("fx_refs", "fx_reads")


def aligned(spark, sf_dir):
    return align.align_join(reads(spark, sf_dir).select("read_id", "seq"), refs(spark, sf_dir).select("ref_id", "seq"), identity=0.85, length=15, top=True)


def placed_of(alignments):
    """Alignments spread by reference, so that all that is counted by reference stays where it is; ids of reads stay behind."""
    n = int(alignments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pileup.placed(alignments).drop("read_id").repartition(n, "ref_id")


def columns_of(alignments):
    return pileup.placed_columns(placed_of(alignments))


@query("j15_align_join", "read_id:s ref_id:s strand:s score:n identity:d alnlen:n", "select read_id, ref_id, strand, score, identity, alnlen from fx_aln", ALN)
def _j15(spark, sf_dir):
    return aligned(spark, sf_dir)


@query("a16_pileup", "ref_id:s pos:n base:s n:n", "select ref_id, pos, base, count(*) as n from fx_cols group by 1, 2, 3", COLS)
def _a16(spark, sf_dir):
    return pileup.pileup(columns_of(aligned(spark, sf_dir)))


CODONS = "(select read_id, ref_id, c, substr(s, cast(3 * c + 1 as int), 3) as codon from (select *, unnest(range(0, 22)) as c from fx_aln) x where 3 * c >= lo and 3 * c + 3 <= n - hi)"


@query("a17_codon_counts", "ref_id:s codon_idx:n codon:s n:n", f"select ref_id, c as codon_idx, codon, count(*) as n from {CODONS} t group by 1, 2, 3", ALN)
def _a17(spark, sf_dir):
    return pileup.placed_codon_counts(placed_of(aligned(spark, sf_dir)))


def genotypes(of: str) -> str:
    """SQL of linked genotypes at codons 1 and 3 over rows (ref_id, a, b) of two codons."""
    return f"select ref_id, a || b as genotype, {_AA.format(c='a')} || {_AA.format(c='b')} as aa, count(*) as n, count(*) * 1.0 / sum(count(*)) over (partition by ref_id) as fraction from ({of}) t group by ref_id, a, b"


@query("a18_linked_genotype", "ref_id:s genotype:s aa:s n:n fraction:d", genotypes(f"select x.ref_id, x.codon as a, y.codon as b from {CODONS} x join {CODONS} y on x.read_id = y.read_id where x.c = 1 and y.c = 3"), ALN)
def _a18(spark, sf_dir):
    return pileup.placed_genotype(pileup.placed(aligned(spark, sf_dir)), [1, 3])


TOP = "(select ref_id, pos, base, n, total from (select *, sum(n) over (partition by ref_id, pos) as total, row_number() over (partition by ref_id, pos order by n desc, base) as k from (select ref_id, pos, base, count(*) as n from fx_cols group by 1, 2, 3) a) b where k = 1)"


@query("a21_consensus_simple", "ref_id:s consensus:s", f"select r.ref_id, string_agg(coalesce(t.base, '-'), '' order by r.pos) as consensus from (select ref_id, unnest(range(1, cast(length(seq) as bigint) + 1)) as pos from fx_refs) r left join {TOP} t on r.ref_id = t.ref_id and r.pos = t.pos group by r.ref_id", COLS)
def _a21(spark, sf_dir):
    return pileup.consensus_simple(pileup.pileup(columns_of(aligned(spark, sf_dir))), refs(spark, sf_dir).select("ref_id", F.length("seq").alias("length")))


@query("a22_consensus_weighted", "ref_id:s consensus:s", f"select ref_id, string_agg(base, '' order by pos) as consensus from {TOP} t group by ref_id", COLS)
def _a22(spark, sf_dir):
    return pileup.consensus_weighted(columns_of(aligned(spark, sf_dir)))


@query("a23_coverage_summary", "ref_id:s mean_total:d std_total:d mean_cons:d", f"select ref_id, avg(total) as mean_total, stddev_samp(total) as std_total, avg(n) as mean_cons from {TOP} t group by ref_id", COLS)
def _a23(spark, sf_dir):
    return pileup.coverage_summary(pileup.coverage(columns_of(aligned(spark, sf_dir))))


@query("a24_alignment_summary", "score:n identity:d coverage:d readlen:n n:n", "select score, round(identity, 2) as identity, round(alnlen * 1.0 / n, 2) as coverage, alnlen as readlen, count(*) as n from fx_aln group by 1, 2, 3, 4", ALN)
def _a24(spark, sf_dir):
    return pileup.alignment_summary(aligned(spark, sf_dir))


@query("j09_join_mates", "pair:s n:n", "select case when strand = '+' then '+-' else '-+' end as pair, count(*) as n from fx_aln group by 1", ALN)
def _j09(spark, sf_dir):
    # the mate of a read is its reverse complement
    mates = reads(spark, sf_dir).select("read_id", S.revcomp("seq").alias("seq"))
    b = align.align_join(mates, refs(spark, sf_dir).select("ref_id", "seq"), identity=0.85, length=15, top=True)
    return align.join_mates(aligned(spark, sf_dir), b).groupBy("pair").agg(F.count("*").alias("n"))


@query("c52_orient", "turned:b n:n")
def _c52(spark, sf_dir):
    return align.orient(reads(spark, sf_dir).select("read_id", "seq"), refs(spark, sf_dir)).groupBy("turned").agg(F.count("*").alias("n"))


BAIT = "ACGTTGCAACGGCTAGCTCGGATC"


@query("c51_fish", "direction:s kind:s n:n", "select case p_partkey % 4 when 0 then 'forward' when 1 then 'backward' when 2 then 'forward' else 'none' end as direction, case p_partkey % 4 when 2 then 'defect' when 3 then 'none' else 'perfect' end as kind, count(*) as n from part group by 1, 2")
def _c51(spark, sf_dir):
    # a read for each part: with the bait, on the other strand, with a letter changed, or without it
    r = refs(spark, sf_dir)
    k = F.substring("ref_id", 2, 20).cast("long") % 4
    spaced = lambda bait: F.concat(F.substring("seq", 1, 20), bait, F.substring("seq", 21, 20))
    seq = F.when(k == 0, spaced(F.lit(BAIT))).when(k == 1, spaced(S.revcomp(F.lit(BAIT)))).when(k == 2, spaced(F.lit(BAIT[:11] + "T" + BAIT[12:]))).otherwise(F.translate("seq", "CG", "TA"))
    return align.fish_summary(align.fish(r.select(F.col("ref_id").alias("read_id"), seq.alias("seq")), BAIT))


@query("c45_locate_flanks", "category:s n:n")
def _c45(spark, sf_dir):
    from seqframe.operators.library import motif_category_counts

    r = refs(spark, sf_dir).select(F.col("ref_id").alias("read_id"), "seq")
    return motif_category_counts(align.locate_flanks(r, "ACGTAACC", "GGTTCCAA"), 5)


# Sites; a head site that differs in three places; circular reads with both sites, the bad head, or none, some backward.
# The rest of a read has two letters (on either strand), so no site is met by chance.
HEAD, TAIL, BAD_HEAD = "ACGTTGCAACGGCTAGCTCG", "CGGATCTTACGGTCAAGCAT", "ACGTAGCAAGGGCTACCTCG"
CIRCLES = {"c": TAIL + HEAD, "d": BAD_HEAD, "n": ""}
CIRCLE_ROWS = " union all ".join(f"select ref_id || '{k}' as read_id, substr(seq, 1, 30) || '{v}' || substr(seq, 31, 34) as seq, '{k}' as kind, seq as whole from (select ref_id, translate(seq, 'GT', 'AC') as seq from fx_refs) r" for k, v in CIRCLES.items())


def circles(spark, sf_dir):
    made = [(k, F.concat(F.substring("seq", 1, 30), F.lit(v), F.substring("seq", 31, 34))) for k, v in CIRCLES.items()]
    rows = F.array(*[F.struct(F.concat("ref_id", F.lit(k)).alias("read_id"), F.when(F.hash("ref_id") % 2 == 0, S.revcomp(c)).otherwise(c).alias("seq") if k == "c" else c.alias("seq")) for k, c in made])
    return refs(spark, sf_dir).withColumn("seq", F.translate("seq", "GT", "AC")).select(F.explode(rows).alias("r")).select("r.*")


@query("c50_linearize", "read_id:s status:s piece:s seq:s", f"""
    select read_id, case kind when 'c' then 'cut' else 'no_cut' end as status, unnest(case kind when 'c' then ['left', 'right'] else ['whole'] end) as piece,
           unnest(case kind when 'c' then [substr(whole, 1, 30) || '{TAIL}', '{HEAD}' || substr(whole, 31, 34)] else [seq] end) as seq
    from ({CIRCLE_ROWS}) t where kind <> 'd'""", ("fx_refs",))  # fmt: skip
def _c50(spark, sf_dir):
    return align.linearize(circles(spark, sf_dir), HEAD, TAIL)


@query("c50_site_counts", "cut:n discard:n no_cut:n ratio:d warning:b", "select count(*) as cut, count(*) as discard, count(*) as no_cut, 1.0 as ratio, true as warning from fx_refs", ("fx_refs",))
def _c50_counts(spark, sf_dir):
    return align.site_counts(align.cut_sites(circles(spark, sf_dir), HEAD, TAIL))


@query("x15_sweep_linearized", "window_size:n cut_quality:n cut:n discard:n no_cut:n n_pieces:n mean:d", """
    with sizes as (select count(*) as n from fx_refs), trims as (select unnest([4, 5, 6, 4, 5, 6]) as window_size, unnest([20, 20, 20, 19, 19, 19]) as cut_quality)
    select window_size, cut_quality, n as cut, n as discard, n as no_cut, 3 * n as n_pieces, (50.0 + 54 + 64) / 3 as mean from trims, sizes""", ("fx_refs",))  # fmt: skip
def _x15_linear(spark, sf_dir):
    d = circles(spark, sf_dir).withColumn("qual", F.array_repeat(F.lit(30), F.length("seq")))
    return align.sweep_linearized(d, HEAD, TAIL).withColumnRenamed("window", "window_size")


@query("c49_pick_subsequence", "seq_id:s seq:s")
def _c49(spark, sf_dir):
    r = refs(spark, sf_dir).select(F.col("ref_id").alias("seq_id"), "seq")
    return align.pick_subsequence(r, "ACGTAACCGGTTACGTCCAA", 0.7)


@query("j16_pairwise_similarity", "a:s b:s identity:d")
def _j16(spark, sf_dir):
    # the stated queries, one in fifty, against all
    r = refs(spark, sf_dir).select(F.col("ref_id").alias("seq_id"), "seq")
    return align.pairwise_similarity(r, queries=F.substring("seq_id", 2, 20).cast("long") % 50 == 0)


@query("j17_map_site", "protein_id:s valid:b reason:s")
def _j17(spark, sf_dir):
    r = refs(spark, sf_dir)
    proteins = r.select(F.col("ref_id").alias("protein_id"), S.translate("seq").alias("seq"))
    sites = proteins.select("protein_id", F.col("protein_id").alias("refs"), F.substring("seq", 5, 1).alias("residue"), F.lit(5).alias("position"))
    return align.map_site(sites, proteins, proteins.withColumnRenamed("protein_id", "ref_id"))


BEST = "(select ref_id from fx_reads group by ref_id order by count(*) desc, ref_id limit 1)"


@query("x01_genotype", "ref_id:s genotype:s aa:s n:n fraction:d", genotypes(f"select ref_id, substr(s, 4, 3) as a, substr(s, 10, 3) as b from fx_aln where ref_id = {BEST}"), ALN)
def _x01(spark, sf_dir):
    return pileup.genotype(reads(spark, sf_dir).select("read_id", "seq"), refs(spark, sf_dir).select("ref_id", "seq"), [1, 3])["genotypes"]


@query("w16_merge_clusters", "cluster_id:s merged:s", "select ref_id || k as cluster_id, ref_id || m as merged from fx_refs, (values ('a', 'a'), ('b', 'a'), ('c', 'c'), ('d', 'd')) as t(k, m)", ("fx_refs",))
def _w16(spark, sf_dir):
    # b meets a and c, c doesn't meet a: b goes to a, so c stays; d is like a, but too large to be absorbed
    r = refs(spark, sf_dir).select("ref_id", random_letters("ref_id").alias("x"))
    kinds = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(at).alias("at"), F.lit(n).cast("long").alias("n")) for k, at, n in (("a", 1, 100), ("b", 13, 30), ("c", 31, 9), ("d", 1, 40))])
    c = r.select("ref_id", "x", F.explode(kinds).alias("t")).select(F.concat("ref_id", "t.k").alias("cluster_id"), F.substring(F.col("x"), F.col("t.at"), F.lit(120)).alias("seq"), "t.n")
    return clusters.merge_clusters(c, length=60)


@query("w17_absorb_singletons", "read_id:s cluster_id:s", "select read_id, ref_id as cluster_id from fx_reads", R)
def _w17(spark, sf_dir):
    consensus = refs(spark, sf_dir).select(F.col("ref_id").alias("cluster_id"), "seq")
    return clusters.absorb_singletons(reads(spark, sf_dir).select("read_id", "seq"), consensus)


@query("x03_cluster_consensus", "cluster_id:s consensus:s")
def _x03(spark, sf_dir):
    d = reads(spark, sf_dir)
    return clusters.cluster_consensus(d.select(F.col("ref_id").alias("cluster_id"), F.col("read_id").alias("seq_id"), "seq", F.lit(1).alias("n"), "ord"))


def planted_clusters(spark, sf_dir):
    """Clusters of each reference: one whose representative lacks a letter, a smaller one that it absorbs, single reads of its own, with a long head, and of nothing."""
    x, other = random_letters("ref_id"), random_letters("other")
    r = refs(spark, sf_dir).select("ref_id", F.concat("ref_id", F.lit("z")).alias("other")).select("ref_id", x.alias("x"), other.alias("z"))
    part = lambda c, at, n: F.substring(c, at, n)
    more = F.concat(part("x", 1, 60), F.translate(part("x", 60, 1), "ACGT", "CGTA"), part("x", 61, 60))
    worse = F.concat(part("x", 13, 49), F.translate(part("x", 62, 1), "ACGT", "CGTA"), part("x", 63, 70))
    rows = [("a", "1", part("x", 1, 120), 40), ("a", "2", more, 30), ("a", "3", more, 30), ("b", "4", part("x", 13, 120), 12), ("b", "5", worse, 8), ("c", "6", S.revcomp(part("x", 1, 118)), 3), ("d", "7", part("z", 1, 120), 2), ("e", "8", F.concat(part("z", 1, 80), part("x", 1, 120)), 1)]
    made = F.array(*[F.struct(F.concat("ref_id", F.lit(c)).alias("cluster_id"), F.concat("ref_id", F.lit(f"s{i}")).alias("seq_id"), seq.alias("seq"), F.lit(n).cast("long").alias("n"), F.lit(int(i)).alias("ord")) for c, i, seq, n in rows])
    return r.select(F.explode(made).alias("m")).select("m.*")


PLANTED = f"(select ref_id, {random_letters_sql('ref_id')} as x from fx_refs)"


@query("x03_rebuild", "cluster_id:s consensus:s n:n depth:d refined:b", f"select ref_id || 'a' as cluster_id, substr(x, 1, 60) || translate(substr(x, 60, 1), 'ACGT', 'CGTA') || substr(x, 61, 60) as consensus, 124 as n, (101 * 121 + 20 * 109 + 3 * 119) / 121.0 as depth, true as refined from {PLANTED} t", ("fx_refs",))
def _x03_rebuild(spark, sf_dir):
    return clusters.rebuild(planted_clusters(spark, sf_dir), identity=0.95, length=60)["consensus"]


@query("x03_members", "cluster_id:s seq_id:s kind:s n:n", f"select ref_id || 'a' as cluster_id, unnest([ref_id || 's1', ref_id || 's2', ref_id || 's3', 'cluster ' || ref_id || 'b/' || substr(md5(substr(x, 13, 120)), 1, 12), ref_id || 's6', ref_id || 's8']) as seq_id, unnest(['member', 'member', 'member', 'absorbed', 'single merged', 'single merged']) as kind, unnest([40, 30, 30, 20, 3, 1]) as n from {PLANTED} t union all select null, ref_id || 's7', 'left single', 2 from fx_refs", ("fx_refs",))
def _x03_members(spark, sf_dir):
    planted = planted_clusters(spark, sf_dir)
    out = clusters.rebuild(planted, identity=0.95, length=60)
    left = out["singles"].join(planted.select(F.col("seq_id").alias("read_id"), "n"), "read_id").select(F.lit(None).cast("string").alias("cluster_id"), F.col("read_id").alias("seq_id"), F.lit("left single").alias("kind"), "n")
    return out["members"].unionByName(left)


FLANKS = "TTGGACCATGTTCCGAATACGCATGGACTTACCGGTACAA", "GGATCCTTCAGGTTAGCCATAAGTCTTGACCGATTGCATG"


def planted_stems(spark, sf_dir):
    """Reads with both flanks, a lone left or right one, a lower arm one letter short, one with a misread end, and one that is no arm."""
    g = F.substring("seq", 9, 21)
    c = F.translate(F.reverse(g), "ACGT", "TGCA")
    left, right, loop = F.lit(FLANKS[0]), F.lit(FLANKS[1]), F.lit("CTCGAG")
    made = {"b": [left, g, loop, c, right], "l": [left, g, loop, c], "r": [g, loop, c, right], "s": [left, g, loop, F.substring(c, 1, 20), right], "c": [left, g, F.lit("CTCGGG"), c, right], "j": [left, g, loop, F.lit("T" * 21), right]}
    rows = F.array(*[F.struct(F.concat("ref_id", F.lit(k)).alias("read_id"), F.concat(*v).alias("seq")) for k, v in made.items()])
    r = refs(spark, sf_dir)
    return r.select(F.explode(rows).alias("r")).select("r.*"), r.select(g.alias("sequence")).distinct().withColumn("library_id", F.col("sequence"))


# A read with a misread loop whose lower arm holds a loop itself parts there, 12 letters or more off, and does not count.
@query("x04_count_library", "sequence:s in_library:b n:n", "select substr(seq, 9, 21) as sequence, true as in_library, sum(case when strpos(substr(seq, 9, 21), 'CTCGAG') = 0 then 5 else 4 end) as n from fx_refs group by 1", ("fx_refs",))
def _x04(spark, sf_dir):
    return clusters.count_library(*planted_stems(spark, sf_dir), *FLANKS)


@query("x04_stem_decisions", "class:s counted:b n:n", """
    select class, counted, sum(n) as n from (select case when strpos(substr(seq, 9, 21), 'CTCGAG') > 0 then 1 else 0 end as inner_loop from fx_refs) t
    cross join (values ('both', true, 3, 2), ('left', true, 1, 1), ('right', true, 1, 1), ('both', false, 1, 2)) v(class, counted, plain, odd)
    cross join lateral (select case when inner_loop = 1 then odd else plain end as n) w group by 1, 2""", ("fx_refs",))  # fmt: skip
def _x04_decisions(spark, sf_dir):
    made = clusters.library_report(*planted_stems(spark, sf_dir), *FLANKS)["decisions"]
    return made.groupBy("class", (F.col("decision") == "counted").alias("counted")).agg(F.sum("n").alias("n"))


# ------------------------------------------------------------ files


@query("s01_fasta_round_trip", "seq_id:s title:s seq:s", "select ref_id as seq_id, title, seq from fx_refs", ("fx_refs",))
def _s01(spark, sf_dir):
    path = shared_folder(spark, "fasta")
    sinks.write_fasta(refs(spark, sf_dir).withColumnRenamed("ref_id", "seq_id"), path, width=20)
    return sequences.read_fasta(spark, path)


@query("s02_fastq_round_trip", "read_id:s seq:s qual:s", "select read_id, seq, qual33 as qual from fx_reads", R)
def _s02(spark, sf_dir):
    path = shared_folder(spark, "fastq")
    sinks.write_fastq(reads(spark, sf_dir).withColumn("qual", S.decode_quality("qual33")), path)
    back = fastq.read_fastq(spark, path)
    return back.withColumn("qual", S.encode_quality("qual"))


@query("s05_hits_round_trip", "query:s target:s length:n n:n", "select query, target, length, count(*) as n from fx_hits group by 1, 2, 3", ("fx_hits",))
def _s05(spark, sf_dir):
    path = shared_folder(spark, "hits")
    h = fixtures.hits(spark, sf_dir)
    h.select("query", "target", "identity", "length", F.lit(0).alias("m"), F.lit(0).alias("g"), "qstart", "qend", "tstart", "tend", "evalue", F.col("score").cast("double").alias("score")).write.csv(path, sep="\t")
    return reports.read_hits_tabular(spark, path).groupBy("query", "target", "length").agg(F.count("*").alias("n"))


@query("s12_gff3_round_trip", "transcript_id:s start_pos:n gene_id:s", "select transcript_id, start_pos, gene_id || ' x' as gene_id from fx_exons", ("fx_exons",))
def _s12(spark, sf_dir):
    path = shared_folder(spark, "gff")
    e = fixtures.exons(spark, sf_dir)
    attrs = F.concat(F.lit("Parent="), "transcript_id", F.lit(";gene="), "gene_id", F.lit("%20x;"))
    e.select(F.concat_ws("\t", "genomicid", F.lit("x"), F.lit("exon"), F.col("start_pos").cast("string"), F.col("end_pos").cast("string"), F.lit("."), "strand", F.lit("."), attrs).alias("value")).write.text(path)
    return features.read_gff3(spark, path).select(F.element_at("attrs", "Parent").alias("transcript_id"), "start_pos", F.element_at("attrs", "gene").alias("gene_id"))


@query("s13_gtf_round_trip", "transcript_id:s start_pos:n gene_id:s", "select transcript_id, start_pos, gene_id from fx_exons", ("fx_exons",))
def _s13(spark, sf_dir):
    path = shared_folder(spark, "gtf")
    e = fixtures.exons(spark, sf_dir)
    attrs = F.concat(F.lit('gene_id "'), "gene_id", F.lit('"; transcript_id "'), "transcript_id", F.lit('";'))
    e.select(F.concat_ws("\t", "genomicid", F.lit("x"), F.lit("exon"), F.col("start_pos").cast("string"), F.col("end_pos").cast("string"), F.lit("."), "strand", F.lit("."), attrs).alias("value")).write.text(path)
    return features.read_gtf(spark, path).select(F.element_at("attrs", "transcript_id").alias("transcript_id"), "start_pos", F.element_at("attrs", "gene_id").alias("gene_id"))


@query("s14_vcf_round_trip", "chrom:s pos:n ac:s", "select 'c' || cast(l_suppkey as varchar) as chrom, l_orderkey as pos, cast(l_linenumber as varchar) as ac from lineitem")
def _s14(spark, sf_dir):
    path = shared_folder(spark, "vcf")
    table(spark, sf_dir, "lineitem").select(F.concat_ws("\t", F.concat(F.lit("c"), F.col("l_suppkey").cast("string")), F.col("l_orderkey").cast("string"), F.lit("."), F.lit("A"), F.lit("G"), F.lit("9"), F.lit("PASS"), F.concat(F.lit("AC="), F.col("l_linenumber").cast("string"), F.lit(";DB"))).alias("value")).write.text(path)
    return features.read_vcf(spark, path)


@query("c14_alignment_table", "read_id:s matches:n score:n ref_end:n", "select cast(l_orderkey as varchar) as read_id, 20 + l_linenumber + l_suppkey % 3 + 5 - 1 - 3 as matches, 10 * (20 + l_linenumber + l_suppkey % 3 + 5 - 4) - 9 - 29 * 2 - 3 as score, l_partkey + 20 + l_suppkey % 3 + 5 - 1 as ref_end from lineitem")
def _c14(spark, sf_dir):
    path = shared_folder(spark, "sam")
    cigar = F.expr("concat('20M', l_linenumber, 'I', case when l_suppkey % 3 = 0 then '' else concat(l_suppkey % 3, 'D') end, '5M')")
    table(spark, sf_dir, "lineitem").select(F.concat_ws("\t", F.col("l_orderkey").cast("string"), F.lit("0"), F.lit("ref"), F.col("l_partkey").cast("string"), F.lit("60"), cigar, F.lit("*"), F.lit("0"), F.lit("0"), F.lit("ACGT"), F.lit("IIII"), F.lit("XM:i:1"), F.lit("XO:i:2"), F.lit("XG:i:3")).alias("value")).write.text(path)
    return features.alignment_table(features.read_sam(spark, path))


@query("s18_clusters_round_trip", "cluster_id:s n:n", "select first as cluster_id, count(*) as n from (select seq_id, min(seq_id) over (partition by cluster_id) as first from fx_clusters) t group by first", ("fx_clusters",))
def _s18(spark, sf_dir):
    path = shared_folder(spark, "clusters")
    c = fixtures.view(spark, sf_dir, "fx_clusters").groupBy("cluster_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("seq_id")), lambda x: F.concat(x, F.lit("_7"))), " ").alias("value"))
    c.select("value").write.text(path)
    return sequences.read_clusters(spark, path).groupBy("cluster_id").agg(F.count("*").alias("n"))


@query("s20_library_round_trip", "sequence:s library_id:s n:n", "select substr(seq, 1, 21) as sequence, ref_id as library_id, 0 as n from fx_refs", ("fx_refs",))
def _s20(spark, sf_dir):
    path = shared_folder(spark, "library")
    refs(spark, sf_dir).select(F.substring("seq", 1, 21), "ref_id").write.csv(path)
    return sequences.read_library(spark, path)


@query("s21_ids_round_trip", "seq_id:s", "select distinct ref_id as seq_id from fx_reads", R)
def _s21(spark, sf_dir):
    path = shared_folder(spark, "ids")
    reads(spark, sf_dir).select("ref_id").write.text(path)
    return sequences.read_ids(spark, path)


@query("s29_raw_lines", "seq:s n:n", "select seq, count(*) as n from fx_reads group by seq", R)
def _s29(spark, sf_dir):
    path = shared_folder(spark, "lines")
    reads(spark, sf_dir).select("seq").write.text(path)
    return sequences.read_raw_lines(spark, path).groupBy("seq").agg(F.count("*").alias("n"))


@query("k03_tsv_round_trip", "c:n name:s", "select n_nationkey as c, case when n_regionkey = 0 then null else n_name end as name from nation")
def _k03(spark, sf_dir):
    path = shared_folder(spark, "tsv")
    sinks.write_tsv(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c"), F.when(F.col("n_regionkey") != 0, F.col("n_name")).alias("name")), path)
    return spark.read.csv(path, sep="\t", header=True, nullValue="\\N", schema="c long, name string")


@query("k10_routed_output", "src:s n:n", "select src, count(*) as n from fx_reads group by src", R)
def _k10(spark, sf_dir):
    path = shared_folder(spark, "routed")
    sinks.write_routed(reads(spark, sf_dir), path, "src")
    return spark.read.parquet(path).groupBy("src").agg(F.count("*").alias("n"))


@query("k11_load_staged", "n_nationkey:n", "select n_nationkey from nation")
def _k11(spark, sf_dir):
    staging, target = shared_folder(spark, "staging"), shared_folder(spark, "target")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sinks.load_staged(nation.filter("n_nationkey < 10"), staging, target, ["n_nationkey"])
    sinks.load_staged(nation, staging, target, ["n_nationkey"])
    return spark.read.parquet(target)
