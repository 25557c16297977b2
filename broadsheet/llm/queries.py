"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import (
    decontamination,
    fill_middle,
    filter_audit,
    language_id,
    lm_scoring,
    near_dedup,
    packing,
    pii,
    quality,
    secrets,
    sharding,
    spans,
    token_counts,
    url_filter,
)
from broadsheet.llm.common import documents, prepare, remainder

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def registered(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@registered
def op1_lm_scoring(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return lm_scoring.score(docs, remainder(F.col("doc_id"), 7) == 2)


@registered
def op2_decontamination(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contaminated(documents(spark, sf_dir), items)


@registered
def op3_secret_scan(spark, sf_dir):
    found = secrets.scan(documents(spark, sf_dir))
    live = F.size(F.filter("spans", lambda s: s["live"])).cast("bigint")
    return found.select(
        "doc_id",
        *spans.digests(F.col("spans"), secrets.BASE),
        live.alias("n_live"),
        (F.size("spans") - live).cast("bigint").alias("n_copied"),
    )


@registered
def op4_quality_rules(spark, sf_dir):
    return quality.judge(documents(spark, sf_dir))


@registered
def op5_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


@registered
def op6_personal_data(spark, sf_dir):
    docs = documents(spark, sf_dir)
    found = pii.find(docs, pii.train(docs))
    return found.select("doc_id", *spans.digests(F.col("spans"), pii.KINDS))


@registered
def op7_near_dedup(spark, sf_dir):
    found = near_dedup.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@registered
def op8_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir))


@registered
def op9_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("bigint"), "text", "lang")
    held = remainder(F.col("doc_id"), 5) == 0
    model = language_id.train(docs.where(~held))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@registered
def op10_sharding(spark, sf_dir):
    placed = sharding.shard(documents(spark, sf_dir))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@registered
def op11_fill_middle(spark, sf_dir):
    output, form = F.col("output"), F.col("form")
    whole = fill_middle.restored(output, form)
    return fill_middle.rearrange(documents(spark, sf_dir)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(output.cast("binary"), 256).alias("output_sha256"),
        F.sha2(whole.cast("binary"), 256).alias("restored_sha256"),
    )


@registered
def op12_url_filter(spark, sf_dir):
    pages = prepare(spark).read.parquet(f"{sf_dir}/pages.parquet")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict", "ratio")


@registered
def op13_filter_audit(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return filter_audit.audit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


# Near-duplicates, all pairs compared. \x0b and \x0c are white space too.
ORACLE["op7_near_dedup"] = """
with recursive
w as (
    select doc_id, [x for x in regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+') if x <> ''] as w
    from documents
),
s as (
    select distinct doc_id, unnest(case
        when len(w) = 0 then []
        when len(w) < 5 then [array_to_string(w, ' ')]
        else [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] end) as g
    from w
),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (
    select a.doc_id as a, b.doc_id as b, count(*) as k
    from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id
),
l as (
    select p.a, p.b from p join n x on x.doc_id = p.a join n y on y.doc_id = p.b
    where 100 * p.k >= 75 * (x.n + y.n - p.k)
),
r as (
    select doc_id, doc_id as other from documents
    union select r.doc_id, l.b from r join l on r.other = l.a
),
c as (select doc_id, min(other) as component_id from r group by doc_id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d join c on c.doc_id = d.doc_id left join n on n.doc_id = d.doc_id
"""

# Units found by the pattern, cut by list slices.
ORACLE["op11_fill_middle"] = """
with
u as (
    select doc_id, coalesce(text, '') as t,
        regexp_extract_all(coalesce(text, ''),
            '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') as u,
        sha256('42:' || coalesce(doc_id::varchar, '')) as h
    from documents
),
h as (
    select *, len(u) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
        ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4
    from u
),
c as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                or h3 % 100 >= 50 then 'plain'
            when h4 % 100 < 80 then 'spm' else 'psm' end as form
    from h
),
p as (
    select doc_id, n, form, t, coalesce(array_to_string(u[1:a], ''), '') as p,
        coalesce(array_to_string(u[a + 1:b], ''), '') as m,
        coalesce(array_to_string(u[b + 1:], ''), '') as s
    from c
)
select doc_id, n, form,
    case when form <> 'plain' then length(p) end as prefix_chars,
    case when form <> 'plain' then length(m) end as middle_chars,
    sha256(case form when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
        when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else t end) as output_sha256,
    sha256(t) as restored_sha256
from p
"""

# Every order walked; Shapley values as sums over all of them.
ORACLE["op13_filter_audit"] = """
with
l as (
    select doc_id, max((coalesce(quality, 0) = 1)::int) as good, max((coalesce(toxic, 0) = 1)::int) as toxic
    from labels where doc_id is not null group by doc_id
),
d as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
        [x for x in regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') if x <> ''] as w
    from documents
),
f as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
        (len(w) < 200) as fa,
        (100 * len(list_distinct(w)) < 50 * len(w)) as fb,
        (100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(t)) as fc,
        regexp_matches(t, '[#$%&*|]') as fd,
        coalesce(d.doc_id > min(d.doc_id) over (partition by t), false) as fe
    from d left join l using (doc_id)
),
m as (
    select part, fa::int + 2 * fb::int + 4 * fc::int + 8 * fd::int + 16 * fe::int as bits,
        count(*) as n, sum(good) as good, sum(toxic) as toxic
    from f group by all
),
x as (select unnest([1, 2, 4, 8, 16]) as b, unnest(['A', 'B', 'C', 'D', 'E']) as f),
o as (
    select a.f || b.f || c.f || d.f || e.f as filter_order, [a.b, b.b, c.b, d.b, e.b] as bs
    from x a, x b, x c, x d, x e
    where (a.b | b.b | c.b | d.b | e.b) = 31
),
k as (
    select filter_order, step, bs[step] as own,
        list_sum(bs[1:step - 1])::int as before, list_sum(bs[1:step])::int as after
    from o, (select unnest([1, 2, 3, 4, 5]) as step)
),
r as (
    select part, filter_order, step, own,
        sum(case when bits & after = 0 then n else 0 end) as kept,
        sum(case when bits & own > 0 and bits & coalesce(before, 0) = 0 then n else 0 end) as removed,
        sum(case when bits & own > 0 and bits & coalesce(before, 0) > 0 then n else 0 end) as redundant,
        sum(case when bits = own then n else 0 end) as unique_fails,
        sum(case when bits & own > 0 and bits & coalesce(before, 0) = 0 then good else 0 end) as good_lost,
        sum(case when bits & own > 0 and bits & coalesce(before, 0) = 0 then toxic else 0 end) as toxic_lost
    from m, k group by all
)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed,
    redundant::bigint as redundant, unique_fails::bigint as unique_fails,
    good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
    (sum(removed) over (partition by part, own))::bigint as shapley
from r
"""
