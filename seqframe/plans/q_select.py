"""Queries for filters, id joins, de-duplication, sets, samples and renaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqframe.functions import sequence as S
from seqframe.operators import dedupe, select, stats, trims
from seqframe.plans import fixtures
from seqframe.plans.registry import joined, query
from seqframe.sources import sinks

table, reads, refs, hits = fixtures.table, fixtures.reads, fixtures.refs, fixtures.hits
R, RR = ("fx_reads",), ("fx_refs", "fx_reads")
Q = "(select read_id, avg(ascii(substr(qual33, cast(i as int), 1)) - 33) as q from (select read_id, qual33, unnest(range(1, cast(length(qual33) as bigint) + 1)) as i from fx_reads) t group by read_id)"


def kept(name, make, where, view="fx_reads", key="read_id"):
    """The keys that a filter leaves."""

    @query(name, f"{key}:s", f"select {key} from {view} where {where}", (view,))
    def run(spark, sf_dir):
        return make(fixtures.view(spark, sf_dir, view)).select(key)


def cnt(letters, c="seq"):
    return f"(length({c}) - length(translate({c}, '{letters.upper()}{letters.lower()}', '')))"


kept("f01_filter_length", lambda d: select.filter_length(d, 30, 60), "length(seq) > 30 and length(seq) < 60")
kept("f01_filter_length_inclusive", lambda d: select.filter_length(d, 30, 60, inclusive=True), "length(seq) >= 30 and length(seq) <= 60")
kept("f02_filter_mean_quality", lambda d: select.filter_mean_quality(d.withColumn("qual", S.decode_quality("qual33")), 25), f"read_id in (select read_id from {Q} z where q > 25)")
kept("f03_filter_accuracy", lambda d: select.filter_accuracy(d.withColumn("qual", S.decode_quality("qual33")), 0.997), f"read_id in (select read_id from {Q} z where q > -10 * log10(1 - 0.997))")
kept("f04_title_contains", lambda d: select.filter_title_contains(d, "RED", 10), "strpos(lower(title), 'red') > 0 and length(seq) > 10", "fx_refs", "ref_id")
kept("f04_title_not", lambda d: select.filter_title_not(d, "RED", 10), "strpos(lower(title), 'red') = 0 and length(seq) > 10", "fx_refs", "ref_id")
kept("f05_title_any", lambda d: select.filter_title_any(d, ["red", "Blue", "1"]), "strpos(lower(title), 'red') > 0 or strpos(lower(title), 'blue') > 0 or strpos(lower(title), '1') > 0", "fx_refs", "ref_id")
kept("f06_filter_gc", lambda d: select.filter_gc(d, ">", 0.5, 30), f"{cnt('GC')} * 1.0 / {cnt('ACGT')} > 0.5 and length(seq) > 30")
kept("f07_filter_unambiguous", lambda d: select.filter_unambiguous(d, 40), "strpos(seq, 'N') = 0 and length(seq) > 40")
kept("f13_residue_position", lambda d: select.residue_position_filter(d, "^..(A.G)"), "regexp_matches(seq, '^..A.G')", "fx_refs", "ref_id")
kept("w12_head_fraction", lambda d: select.head_fraction(d, 0.5), "read_id in (select read_id from (select read_id, sum(length(seq)) over (partition by src order by ord rows between unbounded preceding and current row) as r, sum(length(seq)) over (partition by src) as a from fx_reads) t where r <= 0.5 * a)")


@query("f08_filter_tag", "read_id:s", "select read_id from fx_reads where (ord % 100) / 100.0 > 0.5", R)
def _tag(spark, sf_dir):
    d = reads(spark, sf_dir).withColumn("tags", F.create_map(F.lit("rq"), (F.col("ord") % 100 / 100.0).cast("string")))
    return select.filter_tag(d, "rq", ">", 0.5)


@query("a13_tag_histogram", "value:d n:n", "select l_tax as value, count(*) as n from lineitem group by l_tax")
def _tag_histogram(spark, sf_dir):
    return stats.tag_histogram(table(spark, sf_dir, "lineitem"), "l_tax")


_DOCS = "select doc_id, 'gi|' || cast(doc_id as varchar) || '|gb|' || case when doc_id % 3 = 0 then 'GSS sequence, ' else '' end || source as definition, case when doc_id % 4 = 0 then 'Homo sapiens' when doc_id % 4 = 1 then 'human' else lang end as organism, case doc_id % 5 when 0 then 'Eukaryota; Testudines' when 1 then 'Amphibia; Anura' when 2 then 'Eutheria; Testudines' when 3 then 'Dipnoi' else 'Bacteria' end as lineage from "


def docs(spark, sf_dir):
    return spark.sql(_DOCS.replace("varchar", "string") + "{d}", d=table(spark, sf_dir, "documents"))


@query("f09_split_definition", "doc_id:n gi:s class:s", f"select doc_id, cast(doc_id as varchar) as gi, case when strpos(definition, 'GSS sequence,') > 0 then 'match' else 'rest' end as class from ({_DOCS} documents) d")
def _definition(spark, sf_dir):
    return select.split_definition(docs(spark, sf_dir))


@query("f10_split_organism", "class:s organism:s n:n", f"select class, organism, count(*) as n from (select replace(organism, 'human', 'Homo sapiens') as organism, case when organism in ('human', 'Homo sapiens') then 'match' else 'rest' end as class from ({_DOCS} documents) d) t group by class, organism")
def _organism(spark, sf_dir):
    return select.split_organism(docs(spark, sf_dir), "Homo sapiens", "human").groupBy("class", "organism").agg(F.count("*").alias("n"))


@query("f11_split_lineage", "division:s n:n", f"select case doc_id % 5 when 0 then 'sau' when 1 then 'amp' when 2 then 'sau' when 3 then 'bony' else 'rest' end as division, count(*) as n from ({_DOCS} documents) d group by 1")
def _lineage(spark, sf_dir):
    return select.split_lineage(docs(spark, sf_dir)).groupBy("division").agg(F.count("*").alias("n"))


@query("f14_classify_by_rules", "class:n n:n", """
    select class, count(*) as n from (select case when strpos(lower(p_name), 'red') > 0 then 0 when strpos(lower(p_name), 'blue') > 0 then 1 when strpos(lower(p_name), 'hypothetical') > 0 then 2
      when strpos(lower(p_name), 'green') > 0 then 1 when regexp_matches(seq, 'ACG.*TTT') then 1 else 3 end as class from part p join fx_refs f on f.ref_id = 'p' || cast(p_partkey as varchar)) t group by class""", ("fx_refs",))  # fmt: skip
def _rules(spark, sf_dir):
    return select.classify_by_rules(refs(spark, sf_dir), ["red"], ["blue"], ["green"], ["ACG.*TTT"]).groupBy("class").agg(F.count("*").alias("n"))


_ALN = "select l_orderkey * 10 + l_linenumber as id, 0.9 + l_discount as identity, cast(l_quantity * 10 as int) as alnlen, l_tax * 12 as cov_ref, l_discount * 10 as cov_read, 0.92 + l_tax as nogap_identity, l_linenumber % 4 as gaps_ref, l_linenumber % 3 as gaps_read, l_linenumber % 4 as gaplen_ref, l_suppkey % 3 as gaplen_read from lineitem"


def alignments(spark, sf_dir):
    return spark.sql(_ALN.replace("from lineitem", "from {t}"), t=table(spark, sf_dir, "lineitem"))


_QC = "(alnlen >= 200 and identity >= 0.95 and ((identity > 0.989 and greatest(cov_ref, cov_read) > 0.8) or (gaplen_ref = gaps_ref and gaplen_read = gaps_read and nogap_identity > 0.989)))"
_SALVAGE = "((identity > 0.99 and alnlen > 200) or (greatest(cov_ref, cov_read) > 0.9 and identity > 0.95))"


@query("f20_alignment_pass", "qc:b salvage:b n:n", f"select {_QC} as qc, {_SALVAGE} as salvage, count(*) as n from ({_ALN}) a group by 1, 2")
def _pass(spark, sf_dir):
    d = alignments(spark, sf_dir).select(select.alignment_pass("qc").alias("qc"), select.alignment_pass("salvage").alias("salvage"))
    return d.groupBy("qc", "salvage").agg(F.count("*").alias("n"))


@query("f21_site_match", "ok:b bad:b n:n", f"select identity > 0.88 and alnlen > 16 and cov_ref > 0.7 as ok, identity < 0.92 or gaps_ref > 2 or gaps_read > 2 as bad, count(*) as n from ({_ALN}) a group by 1, 2")
def _site(spark, sf_dir):
    return alignments(spark, sf_dir).select(select.site_match().alias("ok"), select.bad_site().alias("bad")).groupBy("ok", "bad").agg(F.count("*").alias("n"))


@query("f12_drop_low_top_hit", "query:s ord:n", "select h.query, h.ord from fx_hits h join (select query, score, row_number() over (partition by query order by ord) as rn from fx_hits) f on h.query = f.query and f.rn = 1 where f.score > 300", ("fx_hits",))
def _low(spark, sf_dir):
    return select.drop_low_top_hit(hits(spark, sf_dir), 300)


@query("f22_relative_hit_filter", "query:s ord:n", """
    select h.query, h.ord from (select *, length / 50.0 as overlap from fx_hits) h
    join (select query, score as s, identity as i, length / 50.0 as o, row_number() over (partition by query order by ord) as rn from fx_hits) f on h.query = f.query and f.rn = 1
    where not (f.i < 0.05 and f.o < 0.35) and h.score * 1.0 / f.s > 0.4""", ("fx_hits",))  # fmt: skip
def _relative(spark, sf_dir):
    return select.relative_hit_filter(hits(spark, sf_dir).withColumn("overlap", F.col("length") / 50.0), 0.4, 0.05, 0.35)


# (query text, match line, identity, class): each shape of a good alignment alone, each simple stretch, each shape of a good one of simple texts.
FINE = ("|" * 12, "||||..|:|||||||||||.|.||||", "||||||||||....||||||||||", "|||||||..||||||||||..|||||||", "||||||||." * 3, "||||||." * 4, "|||||||||..|||||||||:|||||||||:|", "|:" * 13 + "..||||", "||||||.||||||:|", "||||." * 6, "||||.||||||.||||||..||||", "||." * 20)
SIMPLE = ("S" * 10, "T" * 10, "Q" * 10, "TKA" * 9, "TTA" * 5, "SNN" * 7, "SDD" * 7, "TKR" * 10, "GKR" * 12, "PKD" * 9, "AKRL" * 20, "SSK" * 10, "SK" * 10, "QEK" * 10, "TSK" * 10, "QKRL" * 9, "TTKRLM" * 10, "TTTKRL" * 10, "TKP" * 10)
SIMPLE_FINE = ("|" * 14, "||||||||||.||||||||||", "||||||||." * 3, "|||." * 3 + ".." + "|:" * 10, "||||||." * 4)
PLANTED = [
    *(("ACDEFGHIKLMN", s, 0.5, "good") for s in FINE), *(("ACDEFGHIKLMN", s, 0.96, "bad") for s in ("|||.|||.|||", "||..." * 20, "|" * 11, "")),
    *((t, "|" * 13, 0.5, "bad") for t in SIMPLE), *((t, "|", 0.96, "high-simple") for t in SIMPLE), *(("S" * 10, s, 0.5, "high-simple") for s in SIMPLE_FINE),
]


@query("f23_classify_alignment", "p_partkey:n class:s", f"select p_partkey, list_extract({[c for *_, c in PLANTED]}, cast(p_partkey % {len(PLANTED)} as int) + 1) as class from part")
def _spacer(spark, sf_dir):
    rows = F.array(*[F.struct(F.lit(t if k % 2 else "ACDEFGHIKLMN").alias("query_text"), F.lit(t).alias("target_text"), F.lit(s).alias("spacer"), F.lit(i).alias("identity")) for k, (t, s, i, _) in enumerate(PLANTED)])
    p = table(spark, sf_dir, "part").select("p_partkey", F.get(rows, (F.col("p_partkey") % len(PLANTED)).cast("int")).alias("r")).select("p_partkey", "r.*")
    return select.classify_alignment(p).select("p_partkey", "class")


@query("f24_route_alignment_quality", "class:s n:n", """
    select class, count(*) as n from (select case when a = 'VERY HIGH' or b = 'HIGH NOGAP' then 'good' when b = 'PARTIAL' then 'partial' when a = 'NO COMMON' and b = 'NO COMMON' then 'none' else 'bad' end as class
      from (select case l_linenumber % 3 when 0 then 'VERY HIGH' when 1 then 'NO COMMON' else 'LOW' end as a, case l_suppkey % 4 when 0 then 'HIGH NOGAP' when 1 then 'PARTIAL' when 2 then 'NO COMMON' else 'LOW' end as b from lineitem) x) t group by class""")  # fmt: skip
def _route(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").selectExpr("case l_linenumber % 3 when 0 then 'VERY HIGH' when 1 then 'NO COMMON' else 'LOW' end as q1", "case l_suppkey % 4 when 0 then 'HIGH NOGAP' when 1 then 'PARTIAL' when 2 then 'NO COMMON' else 'LOW' end as q2")
    return select.route_alignment_quality(d).groupBy("class").agg(F.count("*").alias("n"))


# ------------------------------------------------------------ ids


def old_new(spark, sf_dir):
    return fixtures.view(spark, sf_dir, "fx_old"), fixtures.view(spark, sf_dir, "fx_new")


ON = ("fx_old", "fx_new")


@query("f25_missing_outputs", "accession:s", "select distinct accession from fx_old where accession not in (select accession from fx_new)", ON)
def _missing(spark, sf_dir):
    a, b = old_new(spark, sf_dir)
    return select.missing_outputs(a, b, "accession")


@query("j01_pick_by_id", "accession:s version:n", "select accession, version from fx_new where accession in (select accession from fx_old)", ON)
def _pick(spark, sf_dir):
    a, b = old_new(spark, sf_dir)
    return select.pick_by_id(b, a, "accession")


@query("j02_pick_first_by_id", "ref_id:s read_id:s", "select ref_id, read_id from (select ref_id, read_id, row_number() over (partition by ref_id order by src, ord) as rn from fx_reads where ref_id in (select 'p' || cast(p_partkey as varchar) from part where p_size < 20)) t where rn = 1", R)
def _pick_first(spark, sf_dir):
    ids = table(spark, sf_dir, "part").filter("p_size < 20").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("ref_id"))
    return select.pick_first_by_id(reads(spark, sf_dir), ids, "ref_id")


@query("j03_discard_by_id", "read_id:s", "select read_id from fx_reads where ref_id not in (select 'p' || cast(p_partkey as varchar) from part where p_size < 20) and length(seq) >= 40", R)
def _discard(spark, sf_dir):
    ids = table(spark, sf_dir, "part").filter("p_size < 20").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("ref_id"))
    return select.discard_by_id(reads(spark, sf_dir), ids, "ref_id", 40)


@query("j04_split_by_id", "class:s n:n", "select case when accession in (select accession from fx_old) then 'removed' else 'saved' end as class, count(*) as n from fx_new group by 1", ON)
def _split(spark, sf_dir):
    a, b = old_new(spark, sf_dir)
    return select.split_by_id(b, a, "accession").groupBy("class").agg(F.count("*").alias("n"))


@query("j05_pick_new_versions", "accession:s version:n", "select n.accession, n.version from fx_new n left join fx_old o on n.accession = o.accession where o.accession is null or n.version > o.version", ON)
def _versions(spark, sf_dir):
    a, b = old_new(spark, sf_dir)
    return select.pick_new_versions(b, a)


@query("j05_unseen_ids", "accession:s", "select accession from fx_old where accession not in (select accession from fx_new)", ON)
def _unseen(spark, sf_dir):
    return select.unseen_ids(*old_new(spark, sf_dir))


@query("j06_compare_read_sets", "read_id:s old_len:n old_q:d new_len:n new_q:d", f"""
    select r.read_id, case when src <> 'f0' then length(seq) else 0 end as old_len, case when src <> 'f0' then q else 0 end as old_q, case when src <> 'f1' then length(seq) else 0 end as new_len, case when src <> 'f1' then q else 0 end as new_q
    from fx_reads r join {Q} z on r.read_id = z.read_id""", R)  # fmt: skip
def _compare(spark, sf_dir):
    d = reads(spark, sf_dir).withColumn("qual", S.decode_quality("qual33"))
    return select.compare_read_sets(d.filter("src <> 'f0'"), d.filter("src <> 'f1'"))


_SIDES = "select coalesce(o.accession, n.accession) as accession, case when n.accession is null then 'a' when o.accession is null then 'b' else 'both' end as side from fx_old o full outer join fx_new n on o.accession = n.accession"


@query("j07_id_difference", "accession:s side:s", _SIDES, ON)
def _difference(spark, sf_dir):
    return select.id_difference(*old_new(spark, sf_dir), "accession")


@query("u04_shared_ids", "accession:s", f"select accession from ({_SIDES}) s where side = 'both'", ON)
def _shared(spark, sf_dir):
    return select.shared_ids(*old_new(spark, sf_dir), "accession")


@query("u05_only_in_first", "accession:s", f"select accession from ({_SIDES}) s where side = 'a'", ON)
def _only(spark, sf_dir):
    return select.only_in_first(*old_new(spark, sf_dir), "accession")


# ------------------------------------------------------------ duplicates


@query("a05_duplicate_ids", "ref_id:s n:n", "select ref_id, count(*) as n from fx_reads group by ref_id having count(*) > 1", R)
def _dup(spark, sf_dir):
    return dedupe.duplicate_ids(reads(spark, sf_dir), "ref_id")


@query("a06_unique_by_id", "ref_id:s read_id:s seq:s", "select ref_id, read_id, seq from (select *, row_number() over (partition by ref_id order by src, ord) as rn from fx_reads) t where rn = 1", R)
def _unique_id(spark, sf_dir):
    return dedupe.unique_by_id(reads(spark, sf_dir), "ref_id")


_UNIQUE = "select first as read_id, seq, n, dropped from (select seq, count(*) as n, min(case when rn = 1 then read_id end) as first, coalesce(string_agg(case when rn > 1 then read_id end, ',' order by rn), '') as dropped from (select *, row_number() over (partition by seq order by src, ord) as rn from {}) t group by seq) u"


@query("a07_unique_by_sequence", "read_id:s seq:s n:n dropped:s", _UNIQUE.format("fx_reads"), R)
def _unique_seq(spark, sf_dir):
    return dedupe.unique_by_sequence(reads(spark, sf_dir), name="read_id").withColumn("dropped", F.array_join("dropped", ","))


_KEY = "least(seq, reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')))"


@query("a08_collapse_strands", "seq:s n:n qual:s", f"""
    with rows_ as (select {_KEY} as key, seq, ord, read_id, case when seq = {_KEY} then qual33 else reverse(qual33) end as q from fx_reads where length(seq) >= 20),
    means as (select key, i, cast(ceil(avg(ascii(substr(q, cast(i as int), 1)) - 33)) as bigint) as v from (select key, q, unnest(range(1, cast(length(q) as bigint) + 1)) as i from rows_) x group by key, i),
    heads as (select key, count(*) as n, arg_min(seq, ord) as seq from rows_ group by key)
    select h.seq, h.n, case when h.seq = h.key then string_agg(cast(v as varchar), ',' order by i) else string_agg(cast(v as varchar), ',' order by -i) end as qual
    from heads h join means m on h.key = m.key group by h.key, h.seq, h.n""", R)  # fmt: skip
def _collapse(spark, sf_dir):
    d = reads(spark, sf_dir).withColumn("qual", S.decode_quality("qual33"))
    return dedupe.collapse_strands(d).withColumn("qual", joined("qual"))


@query("a09_abundance_histogram", "copies:n n_unique:n", "select copies, count(*) as n_unique from (select seq, count(*) as copies from fx_reads group by seq) t group by copies", R)
def _abundance(spark, sf_dir):
    return dedupe.abundance_histogram(reads(spark, sf_dir))


@query("a09_redundancy", "total:n n_unique:n redundancy:d", "select count(*) as total, count(distinct seq) as n_unique, count(*) * 1.0 / count(distinct seq) as redundancy from fx_reads", R)
def _redundancy(spark, sf_dir):
    return dedupe.redundancy(reads(spark, sf_dir))


@query("u01_combine_unique", "read_id:s seq:s n:n dropped:s", f"""
    select * from ({_UNIQUE.format("(select * from fx_reads where src in ('f0', 'f1')) p")}) a union all select * from ({_UNIQUE.format("(select * from fx_reads where src in ('f2', 'f3') and seq not in (select seq from fx_reads where src in ('f0', 'f1'))) p")}) b""", R)  # fmt: skip
def _combine(spark, sf_dir):
    d = reads(spark, sf_dir)
    both = dedupe.combine_unique(d.filter("src in ('f0', 'f1')").withColumnRenamed("read_id", "seq_id"), d.filter("src in ('f2', 'f3')").withColumnRenamed("read_id", "seq_id"))
    return both.withColumnRenamed("seq_id", "read_id").withColumn("dropped", F.array_join("dropped", ","))


@query("u02_merge_by_id", "ref_id:s read_id:s", "select ref_id, read_id from (select ref_id, read_id, row_number() over (partition by ref_id order by case src when 'f2' then 0 else 1 end, src, ord) as rn from fx_reads) t where rn = 1", R)
def _merge(spark, sf_dir):
    d = reads(spark, sf_dir)
    return dedupe.merge_by_id([d.filter("src = 'f2'"), d.filter("src <> 'f2'")], "ref_id")


@query("u03_concat_mates", "src:s n:n", "select src, count(*) as n from fx_reads group by src", R)
def _concat(spark, sf_dir):
    d = reads(spark, sf_dir)
    return dedupe.concat_mates([d.filter(F.col("src") == f"f{k}") for k in range(4)]).groupBy("src").agg(F.count("*").alias("n"))


# ------------------------------------------------------------ names, samples


@query("p05_to_fasta", "read_id:s value:s", "select read_id, '>' || read_id || ' ' || src || chr(10) || rtrim(regexp_replace(seq, '(.{20})', '\\1' || chr(10), 'g'), chr(10)) as value from fx_reads", R)
def _to_fasta(spark, sf_dir):
    return reads(spark, sf_dir).select("read_id", sinks.fasta_lines("read_id", "src", width=20).alias("value"))


@query("p06_to_table", "read_id:s length:n seq:s", "select read_id, length(seq) as length, seq from fx_reads", R)
def _to_table(spark, sf_dir):
    return stats.length_table(reads(spark, sf_dir), "read_id").join(reads(spark, sf_dir).select("read_id", "seq"), "read_id")


@query("p07_renumber", "read_id:s title:s", "select 'x' || cast(row_number() over (order by src, ord) as varchar) as read_id, read_id || ' t' as title from fx_reads", R)
def _renumber(spark, sf_dir):
    return select.renumber(reads(spark, sf_dir).withColumn("title", F.lit("t")), "x", "read_id")


@query("p08_renumber_mates", "read_id:s new_id:s", "select b || '/' || m as read_id, 'm' || cast(dense_rank() over (order by f) as varchar) || '_' || m as new_id from (select 'c' || cast(o_custkey as varchar) || 'o' || cast(o_orderkey as varchar) as b, unnest(['1', '2']) as m, o_orderkey as f from orders) t")
def _renumber_mates(spark, sf_dir):
    d = table(spark, sf_dir, "orders").withColumn("m", F.explode(F.array(F.lit(1), F.lit(2)))).select((F.col("o_orderkey") * 2 + F.col("m")).alias("ord"), F.expr("concat('c', o_custkey, 'o', o_orderkey, '/', m)").alias("read_id"))
    return select.renumber_mates(d, "m")


@query("p03_swap_title_id", "seq_id:s title:s", "select 'c' || cast(p_partkey as varchar) as seq_id, 'some gi_p' || cast(p_partkey as varchar) as title from part")
def _swap(spark, sf_dir):
    d = refs(spark, sf_dir).select(F.col("ref_id").alias("seq_id"), F.concat(F.lit("c"), F.substring("ref_id", 2, 20), F.lit(" some")).alias("title"))
    return select.swap_title_id(d)


@query("w11_bucket_by_bases", "src:s bases:n bucket:n", """
    with sizes as (select src, sum(length(seq)) as bases, row_number() over (order by src) as k from fx_reads group by src),
    total as (select sum(bases) as t from sizes)
    select s.src, s.bases, (s.k - 1) // 2 as bucket from sizes s""", R)  # fmt: skip
def _buckets(spark, sf_dir):
    # a limit that two of the four sources pass together
    d = reads(spark, sf_dir)
    limit = d.groupBy("src").agg(F.sum(F.length("seq")).alias("n")).agg(F.max("n")).first()[0]
    return select.bucket_by_bases(d, limit)


@query("w13_sample_exact", "read_id:s", "select read_id from fx_reads order by md5('7:' || read_id), read_id limit 100", R)
def _sample(spark, sf_dir):
    return select.sample_exact(reads(spark, sf_dir), 100, 7, "read_id")


@query("w13_sample_sizes", "size:n repeat:n n:n", "select size, repeat, size as n from (select unnest([10, 20]) as size) a, (select unnest([0, 1]) as repeat) b, (select count(*) as c from fx_reads) k", R)
def _samples(spark, sf_dir):
    return select.sample_sizes(reads(spark, sf_dir), [10, 20], 2, key="read_id").groupBy("size", "repeat").agg(F.count("*").alias("n"))


@query("x06_clean_reads", "read_id:s", "select read_id from fx_reads where length(seq) >= 50", R)
def _clean(spark, sf_dir):
    return trims.clean_reads(reads(spark, sf_dir).withColumn("qual", S.decode_quality("qual33")))


@query("x09_clean_short_reads", "seq:s n:n", """
    select seq, count(*) as n from (select case when length(a) >= length(b) then a else b end as seq from (select regexp_extract(t, '^[^N]*') as a, regexp_extract(t, '[^N]*$') as b from (select regexp_replace(regexp_replace(seq, '^N+', ''), 'N+$', '') as t from fx_reads) x) y) z
    where length(seq) >= 26 and not (greatest(""" + ", ".join(cnt(b) for b in "ACGTN") + ") * 1.0 / length(seq) > 0.9) group by seq", R)  # fmt: skip
def _clean_short(spark, sf_dir):
    return trims.clean_short_reads(reads(spark, sf_dir))


_QUALS = "(select read_id, i, ascii(substr(qual33, cast(i as int), 1)) - 33 as q, length(qual33) as n from (select read_id, qual33, unnest(range(1, cast(length(qual33) as bigint) + 1)) as i from fx_reads) a)"
_SUMS = " union all ".join(f"select read_id, i, n, {w} as w, sum(q) over (partition by read_id order by i rows between current row and {w - 1} following) as s from {_QUALS} q" for w in (4, 5, 6))


@query("x15_trim_sweep", "w:n cut:n n_reads:n mean:d std:d", f"""
    select w, cut, count(*) as n_reads, avg(keep) as mean, stddev_samp(keep) as std from (
      select r.read_id, g.w, g.cut, coalesce(k.first - 1, length(r.seq)) as keep from fx_reads r
      cross join (select w, unnest([19, 20]) as cut from (select unnest([4, 5, 6]) as w) x) g
      left join (select read_id, w, cut, min(i) as first from ({_SUMS}) s cross join (select unnest([19, 20]) as cut) c where s < cut * w and i <= n - w + 1 group by 1, 2, 3) k
        on k.read_id = r.read_id and k.w = g.w and k.cut = g.cut) t
    where keep > 17 group by w, cut""", R)  # fmt: skip
def _sweep(spark, sf_dir):
    return trims.trim_sweep(reads(spark, sf_dir).withColumn("qual", S.decode_quality("qual33"))).withColumnRenamed("window", "w")
