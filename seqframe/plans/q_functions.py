"""Queries for the column functions, on the read and reference fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqframe.functions import sequence as S
from seqframe.plans import fixtures
from seqframe.plans.registry import joined, query

RC = "reverse(translate({}, 'ACGTacgt', 'TGCAtgca'))"


def scalar(name: str, make, sql: str, kind: str, view: str = "fx_reads", key: str = "read_id", where: str = ""):
    """One value for each row of a view."""

    @query(name, f"{key}:s value:{kind}", f"select {key}, {sql} as value from {view} {where}", (view,))
    def run(spark, sf_dir):
        df = fixtures.view(spark, sf_dir, view)
        df = df.filter(where.removeprefix("where ")) if where else df
        return df.select(key, make().alias("value"))

    return run


def cnt(letters: str, c: str = "seq") -> str:
    return f"(length({c}) - length(translate({c}, '{letters.upper()}{letters.lower()}', '')))"


scalar("c01_revcomp", lambda: S.revcomp("seq"), RC.format("seq"), "s")
scalar("c02_gc", lambda: S.gc("seq"), f"case when {cnt('ACGT')} > 0 then {cnt('GC')} * 1.0 / {cnt('ACGT')} end", "d")
scalar("c03_rna_to_dna", lambda: S.rna_to_dna(F.translate("seq", "T", "U")), "translate(translate(seq, 'T', 'U'), 'Uu', 'Tt')", "s")
scalar("c04_subseq", lambda: S.subseq("seq", 5, 20), "substr(seq, 5, 16)", "s")
scalar("c04_head", lambda: S.head("seq", 10), "substr(seq, 1, 10)", "s")
scalar("c04_tail", lambda: S.tail("seq", 10), "substr(seq, greatest(length(seq) - 9, 1), 10)", "s")
scalar("c05_delete_range", lambda: S.delete_range("seq", 5, 8), "concat(substr(seq, 1, 4), substr(seq, 9))", "s")
scalar("c05_insert_text", lambda: S.insert_text("seq", 5, "NNN"), "concat(substr(seq, 1, 5), 'NNN', substr(seq, 6))", "s")
scalar("c05_replace_range", lambda: S.replace_range("seq", 5, 8, "nn"), "concat(substr(seq, 1, 4), 'nn', substr(seq, 9))", "s")
scalar("c07_relocate", lambda: S.relocate("seq", 11), "concat(substr(seq, 11), substr(seq, 1, 10))", "s", "fx_refs", "ref_id")
_CODE = "'FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG'"
_AA = f"""case when strpos('TCAG', substr({{c}}, 1, 1)) > 0 and strpos('TCAG', substr({{c}}, 2, 1)) > 0 and strpos('TCAG', substr({{c}}, 3, 1)) > 0
 then substr({_CODE}, cast((strpos('TCAG', substr({{c}}, 1, 1)) - 1) * 16 + (strpos('TCAG', substr({{c}}, 2, 1)) - 1) * 4 + strpos('TCAG', substr({{c}}, 3, 1)) as int), 1) else 'X' end"""


def translated(s: str, frame: int) -> str:
    codon = f"substr({s}, cast({frame} + 3 * i as int), 3)"
    return f"""(select read_id, coalesce(string_agg(aa, '' order by i), '') as value from (select read_id, i, {_AA.format(c=codon)} as aa
      from (select read_id, {s}, unnest(range(0, cast((length({s}) - {frame - 1}) // 3 as bigint))) as i from (select read_id, {{src}} as {s} from fx_reads) q) p) t group by read_id)"""


for _frame in (1, 2, 3):

    @query(f"c06_translate_frame{_frame}", "read_id:s value:s", f"select read_id, value from {translated('z', _frame).format(src='seq')} x", ("fx_reads",))
    def _translate(spark, sf_dir, frame=_frame):
        return fixtures.reads(spark, sf_dir).select("read_id", S.translate("seq", frame).alias("value"))


@query("c06_translate_reverse", "read_id:s value:s", f"select read_id, value from {translated('z', 1).format(src=RC.format('seq'))} x", ("fx_reads",))
def _translate_reverse(spark, sf_dir):
    return fixtures.reads(spark, sf_dir).select("read_id", S.translate("seq", 1, reverse=True).alias("value"))


@query("c08_motif_positions", "read_id:s value:s", """
    select r.read_id, coalesce(string_agg(cast(i as varchar), ',' order by i), '') as value from fx_reads r
    left join (select read_id, i from (select read_id, seq, unnest(range(1, cast(length(seq) as bigint) + 1)) as i from fx_reads) t
               where substr(seq, cast(i as int), 3) in ('TAG', 'TGA', 'TAA')) m on r.read_id = m.read_id group by r.read_id""", ("fx_reads",))  # fmt: skip
def _motifs(spark, sf_dir):
    at = S.motif_positions("seq", "TAG|TGA|TAA")
    return fixtures.reads(spark, sf_dir).select("read_id", joined(at).alias("value"))


_SITES = "select p_partkey, substr(translate(upper(p_name), 'EILOPQJXZFU ', 'RYMKSWBDHVN'), 1, 8) as site from part"


@query("c09_iupac_regex", "p_partkey:n value:s", """
    select p_partkey, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
      translate(site, 'NRYMKSWBDHV', 'nrymkswbdhv'), 'n', '[ACGT]'), 'r', '[AG]'), 'y', '[CT]'), 'm', '[AC]'), 'k', '[GT]'), 's', '[CG]'), 'w', '[AT]'), 'b', '[CGT]'), 'd', '[AGT]'), 'h', '[ACT]'), 'v', '[ACG]') as value
    from (""" + _SITES + ") s")  # fmt: skip
def _iupac(spark, sf_dir):
    return spark.sql(_SITES.replace("from part", "from {part}"), part=fixtures.table(spark, sf_dir, "part")).select("p_partkey", S.iupac_regex("site").alias("value"))


@query("c10_site_weight", "p_partkey:n value:d", f"select p_partkey, {cnt('ACGT', 'site')} + 0.5 * {cnt('RYMKSW', 'site')} + {cnt('BDHV', 'site')} / 3.0 as value from ({_SITES}) s")
def _weight(spark, sf_dir):
    return spark.sql(_SITES.replace("from part", "from {part}"), part=fixtures.table(spark, sf_dir, "part")).select("p_partkey", S.site_weight("site").alias("value"))


@query("c12_attributes", "l_orderkey:n value:s name:s", """
    select l_orderkey, 'ID=' || cast(l_partkey as varchar) || '; Note=a b' as value, cast(l_partkey as varchar) as name from lineitem where l_linenumber = 1""")  # fmt: skip
def _attrs(spark, sf_dir):
    from seqframe.sources.features import parse_gff_attributes

    rows = fixtures.table(spark, sf_dir, "lineitem").filter("l_linenumber = 1")
    text = F.concat(F.lit("Note=a%20b;ID="), F.col("l_partkey").cast("string"), F.lit(";"))
    return rows.select("l_orderkey", parse_gff_attributes(text).alias("a")).select("l_orderkey", S.attributes_to_string("a").alias("value"), F.element_at("a", "ID").alias("name"))


_CIGAR = "cast(l_partkey % 90 + 1 as varchar) || 'M' || cast(l_suppkey % 9 + 1 as varchar) || 'I' || cast(l_linenumber as varchar) || 'D5M'"
for _op, _sum in (("MID", "l_partkey % 90 + 1 + l_suppkey % 9 + 1 + l_linenumber + 5"), ("D", "l_linenumber"), ("I", "l_suppkey % 9 + 1")):

    @query(f"c13_cigar_{_op.lower()}", "l_orderkey:n l_linenumber:n value:n", f"select l_orderkey, l_linenumber, {_sum} as value from lineitem")
    def _cigar(spark, sf_dir, op=_op):
        rows = fixtures.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", _CIGAR.replace("varchar", "string") + " as cigar")
        return rows.select("l_orderkey", "l_linenumber", S.cigar_length("cigar", op).alias("value"))


def quals(col_sql: str) -> str:
    return f"(select read_id, i, ascii(substr(qual33, cast(i as int), 1)) - 33 as q, length(qual33) as n from (select read_id, qual33, unnest(range(1, cast(length(qual33) as bigint) + 1)) as i from fx_reads) t)" + col_sql


scalar("c15_shift_quality", lambda: S.encode_quality(S.shift_quality(S.decode_quality("qual33"), 2)), "translate(qual33, '+-/13579;=?ACEGI', '-/13579;=?ACEGIK')", "s")


@query("c16_trim_low_quality", "read_id:s value:s", f"""
    select r.read_id, substr(r.seq, 1, cast(coalesce(k.first - 1, length(r.seq)) as int)) as value from fx_reads r left join (
      select read_id, min(i) as first from (select read_id, i, n, sum(q) over (partition by read_id order by i rows between current row and 5 following) as s from {quals('')} a) b
      where s < 120 and i <= n - 5 group by read_id) k on r.read_id = k.read_id
    where coalesce(k.first - 1, length(r.seq)) > 17""", ("fx_reads",))  # fmt: skip
def _trim(spark, sf_dir):
    from seqframe.operators.trims import trim_low_quality

    return trim_low_quality(fixtures.reads(spark, sf_dir).withColumn("qual", S.decode_quality("qual33"))).select("read_id", F.col("seq").alias("value"))


scalar("c21_trim_poly_a", lambda: S.trim_poly_a(F.concat("seq", F.lit("GAAAAAA"))), "regexp_replace(seq || 'GAAAAAA', '[aA]{5,}$', '')", "s")


def chained(text: str, rules) -> str:
    """SQL of regular-expression replacements one after the other."""
    for pattern, keep in rules:
        text = f"regexp_replace({text}, '{pattern}', '{keep}', 'g')"
    return text


scalar("c22_expose_poly_tail", lambda: S.expose_poly_tail(F.concat(F.lit("ACG"), F.lit("T" * 14), "seq", F.lit("A" * 14 + "CGC"))), chained("'ACG" + "T" * 14 + "' || seq || '" + "A" * 14 + "CGC'", [(r, r"\1") for r in S.POLY_HEADS + S.POLY_TAILS]), "s")
scalar("c20_second_n_rule", lambda: S.second_n_rule("seq", 25), "case when length(seq) - length(replace(seq, 'N', '')) < 2 then seq when strpos(substr(seq, cast(strpos(seq, 'N') + 1 as int)), 'N') + strpos(seq, 'N') > 25 then substr(seq, 1, cast(strpos(substr(seq, cast(strpos(seq, 'N') + 1 as int)), 'N') + strpos(seq, 'N') - 1 as int)) end", "s")
scalar("c18_trim_n_ends", lambda: S.trim_n_ends("seq"), "regexp_replace(regexp_replace(seq, '^[Nn]+', ''), '[Nn]+$', '')", "s")
_PARTS = "string_split_regex(regexp_replace(regexp_replace('NN' || seq || 'NNN' || substr(seq, 1, cast(ord % 40 as int)) || 'N', '^N+', ''), 'N+$', ''), 'N+')"
_FIRST_LONGEST = f"list_filter({_PARTS}, lambda p: length(p) = list_max(list_transform({_PARTS}, lambda x: length(x))))[1]"
scalar("c17_trim_n_longest", lambda: S.trim_n_longest(F.concat(F.lit("NN"), "seq", F.lit("NNN"), F.substring(F.col("seq"), F.lit(1), (F.col("ord") % 40).cast("int")), F.lit("N"))), f"case when length({_FIRST_LONGEST}) >= 26 then {_FIRST_LONGEST} end", "s")
scalar("c19_trim_vector_x", lambda: S.trim_vector_x(F.concat(F.lit("ACGTXX"), "seq", F.lit("XACG")), 10, 20), "case when length(seq) >= 20 then seq end", "s")
scalar("c23_simple_trim", lambda: S.simple_trim(F.concat(F.lit("ACTTTTTTTTTTTT"), F.lit("GCGC"), "seq", F.lit("GCGCAAAAAAA"))), chained("'ACTTTTTTTTTTTTGCGC' || seq || 'GCGCAAAAAAA'", [(p, k.replace("$", "\\")) for p, k in S.SIMPLE_TRIMS]), "s")


@query("c28_hamming", "read_id:s value:n", """
    select read_id, sum(case when substr(a, cast(i as int), 1) <> substr(b, cast(i as int), 1) then 1 else 0 end) as value
    from (select read_id, a, b, unnest(range(1, 25)) as i from (select r.read_id, substr(r.seq, 1, 24) as a, substr(f.seq, 1, 24) as b from fx_reads r join fx_refs f on r.ref_id = f.ref_id) x) y group by read_id""", ("fx_refs", "fx_reads"))  # fmt: skip
def _hamming(spark, sf_dir):
    refs = fixtures.refs(spark, sf_dir).select("ref_id", F.col("seq").alias("ref"))
    return fixtures.reads(spark, sf_dir).join(refs, "ref_id").select("read_id", S.prefix_diff("seq", "ref", 24).alias("value"))


scalar("c28_suffix_diff", lambda: S.suffix_diff("seq", F.reverse("seq"), 2), "(case when substr(seq, length(seq) - 1, 1) <> substr(seq, 2, 1) then 1 else 0 end) + (case when substr(seq, length(seq), 1) <> substr(seq, 1, 1) then 1 else 0 end)", "n")


@query("c29_round2", "l_orderkey:n l_linenumber:n value:d", "select l_orderkey, l_linenumber, l_discount as value from lineitem")
def _round2(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.round2("l_discount").alias("value"))


@query("c30_length_adjust", "l_orderkey:n l_linenumber:n value:d", "select l_orderkey, l_linenumber, greatest(1.0, 2.5 - 0.009 * l_quantity * 6) as value from lineitem")
def _adjust(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.length_adjust(F.col("l_quantity") * 6).alias("value"))


scalar("c31_repeat_base_count", lambda: S.repeat_base_count(F.translate("seq", "CGN", "A-"), "A"), "case when regexp_matches(replace(translate(seq, 'CGN', 'A-'), '-', ''), '^A*$') then length(replace(translate(seq, 'CGN', 'A-'), '-', '')) end", "n")


@query("f03_accuracy_to_q", "l_orderkey:n l_linenumber:n value:d", "select l_orderkey, l_linenumber, -10 * log10(1 - (0.5 + l_discount)) as value from lineitem")
def _accuracy(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.accuracy_to_q(0.5 + F.col("l_discount")).alias("value"))


@query("p11_fraction_to_bips", "l_orderkey:n l_linenumber:n value:n", "select l_orderkey, l_linenumber, cast(floor(l_discount * 10000 + 0.5) as bigint) as value from lineitem")
def _bips(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.fraction_to_bips("l_discount").alias("value"))


scalar("p01_normalise_id", lambda: S.normalise_id(F.when(F.col("ord") % 3 == 0, F.concat(F.lit(">gi|12|ref|AB"), F.col("ord").cast("string"), F.lit(".1| title"))).when(F.col("ord") % 3 == 1, F.concat(F.lit("UniRef50_"), "read_id", F.lit(" x"))).otherwise(F.concat(F.lit("DB:"), "ref_id", F.lit(".2 t")))), "case when ord % 3 = 0 then 'AB' || cast(ord as varchar) when ord % 3 = 1 then read_id else ref_id end", "s")
scalar("p02_shorten_movie_name", lambda: S.shorten_movie_name(F.concat(F.lit("m1/"), "read_id", F.lit("/"), "src", F.lit("/ccs"))), "'ccs' || read_id || '/' || src", "s")
scalar("p13_strip_key_prefix", lambda: S.strip_key_prefix("read_id"), "split_part(read_id, '_', 2)", "s")
scalar("p15_codon_start", lambda: S.codon_start("ord", F.lit(1)), "((1 - ord) % 3 + 3) % 3 + 1", "n")
scalar("p04_mapping_name", lambda: S.mapping_name(F.when(F.col("ord") % 2 == 0, "Homo sapiens").otherwise("bacterium"), F.col("src")), "case when ord % 2 = 0 then 'Homo sapiens' else 'bacterium ' || src end", "s")
scalar("f13_residues", lambda: F.regexp_extract("seq", "^..(A.G)", 1), "regexp_extract(seq, '^..(A.G)', 1)", "s", "fx_refs", "ref_id")

# run tests of single sequences
RUN_SUM = "(select read_id, {agg} as v from (select read_id, p - rn as island, b, count(*) as len from (select read_id, i as p, substr(seq, cast(i as int), 1) as b, row_number() over (partition by read_id, substr(seq, cast(i as int), 1) order by i) as rn from (select read_id, seq, unnest(range(1, cast(length(seq) as bigint) + 1)) as i from fx_reads) x) y group by read_id, b, p - rn) z group by read_id)"


def run_rule(name: str, make, agg: str, rule: str):
    @query(name, "read_id:s value:b", f"select r.read_id, {rule} as value from fx_reads r join {RUN_SUM.format(agg=agg)} s on r.read_id = s.read_id", ("fx_reads",))
    def run(spark, sf_dir):
        return fixtures.reads(spark, sf_dir).select("read_id", make().alias("value"))


run_rule("f15_is_artifact", lambda: S.is_artifact("seq", 1, 0.5), "sum(case when len > 1 then len else 0 end)", "v > 0.5 * length(seq)")
run_rule("f19_is_junk_repeat", lambda: S.is_junk_repeat("seq", 0.27, 3), "sum(case when len >= 3 then len else 0 end)", "v > 0.27 * length(seq)")
run_rule("f18_has_long_polymer", lambda: S.has_long_polymer("seq", 5), "max(case when b <> 'N' then len else 0 end)", "v >= 5")
scalar("f16_is_simple", lambda: S.is_simple("seq", 0.4), "greatest(" + ", ".join(cnt(b) for b in "ACGTN") + ") * 1.0 / length(seq) > 0.4", "b")
scalar("f16_is_low_complexity", lambda: S.is_low_complexity("seq", 0.4), "(" + " + ".join(f"case when {cnt(b)} > 0 then 1 else 0 end" for b in "ACGTN") + ") <= 2 or greatest(" + ", ".join(cnt(b) for b in "ACGTN") + ") * 1.0 / length(seq) > 0.4", "b")
scalar("f17_is_repeat", lambda: S.is_repeat("seq", 0.1), "greatest(" + ", ".join(f"coalesce((select max(length(t.x)) from (select unnest(regexp_extract_all(seq, '[{b}N]+')) as x) t), 0)" for b in "ACGT") + ") * 1.0 / length(seq) > 0.1", "b")
scalar("f07_is_unambiguous", lambda: S.is_unambiguous("seq"), "strpos(seq, 'N') = 0", "b")
