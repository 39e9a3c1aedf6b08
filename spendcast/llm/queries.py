"""Registered queries ``opN_*`` over the fixture tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (exact_dedup, filter_audit, line_dedup, merge_dropout, near_dedup, packing, quality_crf, quality_rules,
               substring_dedup, suffix_dedup, token_alignment, toxicity, url_filters)

QUERIES = {}
ORACLE = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f
    return add


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query(r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
win as (select doc_id, i, array_to_string(ws[i:i + 12], ' ') as g
        from (select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from d)),
src as (select g, min(doc_id) as first_doc from win group by g),
gone as (select distinct doc_id, p from (select doc_id, unnest(range(i, i + 13)) as p
         from win join src using (g) where first_doc < doc_id)),
word as (select doc_id, p, ws[p] as w from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as p from d)),
kept as (select doc_id, string_agg(w, ' ' order by p) as t from word anti join gone using (doc_id, p) group by doc_id),
n as (select doc_id, count(*) as n_removed from gone group by doc_id)
select d.doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id) left join n using (doc_id)
""")
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(_docs(spark, sf_dir))


@query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(_docs(spark, sf_dir))


@query(r"""
with d as (select doc_id, length(coalesce(text, '')) as chars,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents)
select doc_id, first(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size,
       first(doc_id) over w = doc_id as kept, text_sha256
from d window w as (partition by text_sha256 order by chars desc, doc_id)
""")
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(_docs(spark, sf_dir))


@query()
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_docs(spark, sf_dir))


@query()
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.decisions(_docs(spark, sf_dir))


@query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_docs(spark, sf_dir))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query()
def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return quality_crf.score(docs, quality_crf.train(docs, _labels(spark, sf_dir)))


@query()
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    # a page's url ends in the id of the document it shows, which labels.quality marks
    shown = F.regexp_extract(url_filters.path_of(F.col("url")), r"/([0-9]{1,18})(?:[./]|$)", 1)
    good = pages.select("page_id", F.try_to_number(shown, F.lit("999999999999999999")).cast("long").alias("doc_id")).join(
        _labels(spark, sf_dir).select("doc_id", F.col("quality").alias("good")), "doc_id").select("page_id", "good")
    return url_filters.judge(pages, good)


@query()
def op6_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, _labels(spark, sf_dir)))


@query()
def op10_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_dropout.digests(_docs(spark, sf_dir))


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.measures(_docs(spark, sf_dir))


@query(r"""
with l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
t as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
d as (select doc_id, part, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'),
             coalesce(doc_id > min(doc_id) over (partition by text), false)] as f from t),
c as (select part, f, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
      from d left join l using (doc_id) group by part, f),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
o as (select concat(a.x, b.x, c.x, d.x, e.x) as filter_order from x a, x b, x c, x d, x e
      where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s as (select filter_order, step::int as step, ascii(filter_order[step:step]) - 64 as i,
             list_transform(range(1, step), lambda k: ascii(filter_order[k:k]) - 64) as before
      from o, (select unnest(range(1, 6)) as step)),
e as (select part, filter_order, step, i, n, good, toxic, f[i] as fails,
             len(list_filter(before, lambda k: f[k])) > 0 as gone, len(list_filter([1, 2, 3, 4, 5], lambda k: f[k])) as many
      from c, s),
r as (select part, filter_order, step, i, sum(case when not gone and not fails then n else 0 end)::bigint as kept,
             sum(case when not gone and fails then n else 0 end)::bigint as removed,
             sum(case when gone and fails then n else 0 end)::bigint as redundant,
             sum(case when fails and many = 1 then n else 0 end)::bigint as unique_fails,
             sum(case when not gone and fails then good else 0 end)::bigint as good_lost,
             sum(case when not gone and fails then toxic else 0 end)::bigint as toxic_lost
      from e group by part, filter_order, step, i)
select * exclude (i), (sum(removed) over (partition by part, i))::bigint as shapley from r
""")
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(_docs(spark, sf_dir), _labels(spark, sf_dir))


@query(r"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
l as (select doc_id, p, ls[p] as line from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as p from d)),
k as (select doc_id, p, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
many as (select key, max(doc_id) as last_doc from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
m as (select doc_id, p, line, coalesce(doc_id <> last_doc, false) as gone from k left join many using (key))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by p) filter (where not gone), '')) as kept_sha256
from m group by doc_id
""")
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(_docs(spark, sf_dir))
