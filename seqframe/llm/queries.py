"""Registered queries of the corpus operators, with their oracle SQL."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from seqframe.llm import collocations, decontaminate, hard_negatives, html_text, katz, licenses, mixing, neardup, quality, search, surrogates, token_counts, token_store
from seqframe.llm.common import table


def op1_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.leak_digest(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = search.search(docs, docs.filter(search.every_fiftieth(docs)))
    return found.withColumnRenamed("query", "query_id")


def op3_near_duplicates(spark, sf_dir):
    documents, _ = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return neardup.group_classes(documents)


def op4_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text.extract(pages, html_text.fit(pages), drop_source=True)
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op5_mix_sources(spark, sf_dir):
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op6_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality.fit(docs, table(spark, sf_dir, "labels"), quality.crc("doc_id", 5) != 0)
    scored = quality.score(docs.withColumn("held_out", quality.crc("doc_id", 5) == 0), weights, drop_text=True)
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op7_katz_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return katz.score(docs, quality.crc("doc_id", 7) != 2)


def op8_token_store(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return token_store.store_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))


def op9_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), drop_text=True)
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op10_pii_surrogates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_pii(docs, key=b"surrogate key of the registered query")


def op11_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", hard_negatives.quantised("embedding").alias("vector"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_collocations(spark, sf_dir):
    return collocations.mine(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_license_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.digest(licenses.scan(docs)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def queries():
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()} | {"pipeline": corpus_pipeline.run}


def oracle_sql():
    return {"op1_decontaminate": OP1_SQL, "op11_hard_negatives": OP11_SQL, "op12_collocations": OP12_SQL, "op13_license_scan": licenses.oracle()}


OP1_SQL = """
with docs as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents),
items as (
  select cast(item_id as varchar) as item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark),
windows as (
  select distinct item, least(10, len(w)) as n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as k
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from items where len(w) > 0)),
sizes as (select distinct n from windows),
grams as (
  select r, i, n, array_to_string(w[i : i + n - 1], ' ') as k
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from docs, sizes where len(w) >= n)),
hits as (select g.r, g.i, g.n, x.item from grams g join windows x on g.n = x.n and g.k = x.k),
words as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hits) group by r),
found as (select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as ids from hits group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(a.n_hit, 0) as bigint) as n_hit,
       cast(coalesce(f.n_items, 0) as bigint) as n_items, sha256(coalesce(f.ids, '')) as items_sha256,
       coalesce(a.n_hit, 0) > 0 as contaminated
from docs d left join words a using (r) left join found f using (r)
"""


OP11_SQL = """
with eligible as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
  select a.r as ar, a.vec_id as anchor_id, a.label as own, b.r as br, b.vec_id as id, b.label as label,
         cast(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) as bigint) as score
  from eligible a join eligible b on a.vec_id % 100 = 0 and a.r <> b.r),
positives as (
  select * from scored where label = own
  qualify row_number() over (partition by ar order by score desc, id nulls last, br) <= 5),
negatives as (
  select p.anchor_id, p.id as positive_id, n.id as negative_id, p.score as positive_score, n.score as negative_score,
         row_number() over (partition by p.ar, p.br order by n.score desc, n.id nulls last, n.br) as rank
  from positives p join scored n on n.ar = p.ar and n.label <> n.own and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from negatives where rank <= 5
"""

OP12_SQL = """
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
words as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
grams as (
  select lang, m, array_to_string(w[i : i + m - 1], ' ') as phrase
  from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from words, (values (1), (2), (3), (4), (5)) as sizes(m) where len(w) >= m)),
counts as (select lang, m, phrase, count(*) as f from grams group by all),
totals as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
frequent as (select * from counts where m > 1 and f >= 100),
kept as (
  select * from frequent s where not exists (
    select 1 from frequent b where b.lang = s.lang and b.m > s.m and 100 * b.f >= 100 * s.f and contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' '))),
cuts as (
  select lang, phrase, f, k, array_to_string(w[1 : k], ' ') as head, array_to_string(w[k + 1 : m], ' ') as tail
  from (select lang, m, phrase, f, string_split(phrase, ' ') as w, unnest(range(1, m)) as k from kept)),
scored as (
  select c.lang, c.phrase, c.f as a, l.f as l, r.f as r, t.n as n,
         (cast(1000 as hugeint) * c.f * t.n) // (cast(l.f as hugeint) * r.f) as score, k
  from cuts c join counts l on l.lang = c.lang and l.phrase = c.head join counts r on r.lang = c.lang and r.phrase = c.tail join totals t on t.lang = c.lang),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from lowest)
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, n, cast(score as bigint) as score
from ranked where rank <= 2000
"""
