"""Queries of the operators of this subpackage over the given tables, and their checks in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from . import attention, chat, decontaminate, infill, language, lengths, neardup, negatives, packing, quality, repeats, urls, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.statistics(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    return quality.judge(stats).drop("lang", "source")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.fit(docs.where(~held_out & F.col("lang").isNotNull()))
    return language.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    matched = decontaminate.match_windows(docs, table(spark, sf_dir, "benchmark"))
    return matched.select(
        "doc_id",
        F.col("_match.n_words").alias("n_words"),
        F.col("_match.n_hit").alias("n_hit"),
        F.size("_match.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("_match.items"), ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.score(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 10 == 0)


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("url")


def op7_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.limits(lengths.histogram(table(spark, sf_dir, "documents")))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = neardup.link(table(spark, sf_dir, "documents"), words=2)
    return linked.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    told = (F.lit(-1), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(control))
    extra = spark.range(2).select(*[value.cast(f.dataType).alias(f.name) for value, f in zip(told, rows.schema.fields, strict=True)])
    turns = chat.canonical_turns(chat.group_turns(rows.unionByName(extra)), "conv_id")
    return chat.digest(chat.format_turns(turns))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(table(spark, sf_dir, "documents")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", label), anchors=F.col("vec_id") % 50 == 0)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = f"{work_dir(spark).rstrip('/')}/tessera/{uuid.uuid4().hex}"
    warc.write(table(spark, sf_dir, "pages"), archives)
    return warc.digest(warc.read(spark, archives))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digest(infill.transform(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_quality, op2_language, op3_decontaminate, op4_lm_score, op5_pack, op6_url_filter, op7_length_histogram, op8_near_duplicates, op9_chat, op10_repeats, op11_hard_negatives, op12_warc, op13_fill_in_middle)}

CHECKS = {
    "op3_decontaminate": r"""
with d as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from documents),
b as (
    select item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from benchmark where item_id is not null),
p as (
    select distinct item_id, least(len(w), 13) as n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') as win
    from (select item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) as i from b where len(w) > 0)),
lengths as (select distinct n from p),
win as (
    select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as win
    from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, lengths where len(w) >= n)),
m as (select win.doc_id, win.i, win.n, p.item_id from win join p on win.win = p.win and win.n = p.n),
hit as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from (select distinct doc_id, i, n from m)) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list from (select distinct doc_id, cast(item_id as varchar) as item from m) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit using (doc_id) left join items using (doc_id)
""",
    "op6_url_filter": r"""
with u as (
    select page_id, coalesce(url, '') as url from pages),
p as (
    select page_id,
        translate(regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)', 2, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)', 3, 's') as path
    from u),
r(verdict, h, p) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
j as (
    select page_id, arg_max(h || r.p, length(h || r.p)) as rule, arg_max(verdict, length(h || r.p)) as verdict
    from p join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, r.p) group by page_id)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from p left join j using (page_id)
""",
    "op8_near_duplicates": r"""
with recursive d as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
    from documents),
s as materialized (
    select distinct doc_id, case when len(w) = 1 then w[1] else w[i] || ' ' || w[i + 1] end as g
    from (select doc_id, w, unnest(range(1, greatest(len(w), 2))) as i from d where len(w) > 0)),
n as materialized (select doc_id, count(*) as n from s group by doc_id),
links as materialized (
    select x.doc_id as a, y.doc_id as b from s x join s y on x.g = y.g and x.doc_id < y.doc_id
    join n nx on nx.doc_id = x.doc_id join n ny on ny.doc_id = y.doc_id
    where least(nx.n, ny.n) * 100 >= greatest(nx.n, ny.n) * 80
    group by x.doc_id, y.doc_id, nx.n, ny.n having 100 * count(*) >= 80 * (nx.n + ny.n - count(*))),
both_ways as materialized (select a, b from links union all select b, a from links),
reach as (
    select distinct a as doc_id, a as other from both_ways
    union select r.doc_id, l.b from reach r join both_ways l on l.a = r.other)
select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(c.least_id, d.doc_id) as component_id, d.doc_id = coalesce(c.least_id, d.doc_id) as kept
from d left join n using (doc_id) left join (select doc_id, min(other) as least_id from reach group by doc_id) c using (doc_id)
""",
    "op10_repeats": r"""
with d as materialized (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
p as materialized (select doc_id, i, md5(h[2 * i + 1:2 * i + 400]) as k from (select doc_id, h, unnest(range(0, len(h) // 2 - 199)) as i from d where len(h) >= 400)),
r as materialized (select doc_id, i from p where k in (select k from p group by k having count(*) > 1)),
g as (select *, case when i <= lag(i) over w + 200 then 0 else 1 end as opens from r window w as (partition by doc_id order by i)),
spans as (
    select doc_id, min(i) as a, max(i) + 200 as b from (select *, sum(opens) over (partition by doc_id order by i) as g from g) group by doc_id, g),
cut as (
    select doc_id, a, b, lag(b, 1, 0) over (partition by doc_id order by a) as from_ from spans),
kept as (
    select doc_id, count(*) as n_spans, sum(b - a) as n_removed, max(b) as last, string_agg(h[2 * from_ + 1:2 * a], '' order by a) as head
    from cut join d using (doc_id) group by doc_id)
select doc_id, len(h) // 2 as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
    sha256(unhex(coalesce(head, '') || h[2 * coalesce(last, 0) + 1:])) as kept_sha256
from d left join kept using (doc_id)
""",
    "op9_chat": r"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t as (
    select *, length(replace(replace(replace(role, '␛', '␛␛'), '<|', '<␛|'), '|>', '|␛>')) + length(replace(replace(replace(text, '␛', '␛␛'), '<|', '<␛|'), '|>', '|␛>')) as shown
    from rows)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    length(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
    cast(sum(shown + 18) as bigint) as formatted_chars
from t group by conv_id
""",
    "op11_hard_negatives": r"""
with v as materialized (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256.0 * x::double)) as q
    from embeddings
    where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as materialized (
    select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, cast(list_inner_product(a.q, b.q) as bigint) as score
    from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
p as (
    select anchor_id, other_id as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, positive_id, cast(row_number() over w as integer) as rank, other_id as negative_id, positive_score, score as negative_score
from p join s on s.anchor_id = p.anchor_id and not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
window w as (partition by p.anchor_id, positive_id order by score desc, other_id)
qualify row_number() over w <= 3
""",
    "op12_warc": r"""
with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
g as (select payload_digest, payload_bytes, max(page_id) as to_id, count(*) as n from p where payload_bytes >= 1000 group by all)
select page_id, payload_bytes, payload_digest,
    case when n > 1 and page_id is distinct from to_id then 'revisit' else 'response' end as record_type,
    case when n > 1 and page_id is distinct from to_id then to_id end as refers_to
from p left join g using (payload_digest, payload_bytes)
""",
    "op13_fill_in_middle": r"""
with d as (
    select doc_id, coalesce(text, '') as t, cast(length(coalesce(text, '')) as bigint) as n, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
r as (
    select doc_id, t, n, cast('0x' || h[1:8] as ubigint) % (n + 1) as x, cast('0x' || h[9:16] as ubigint) % (n + 1) as y,
        case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or cast('0x' || h[17:24] as ubigint) % 100 >= 90 then 'plain'
            when cast('0x' || h[25:32] as ubigint) % 100 < 20 then 'spm' else 'psm' end as form
    from d),
c as (
    select *, cast(least(x, y) as bigint) as a, cast(greatest(x, y) as bigint) as b, substring(t, 1, cast(least(x, y) as bigint)) as p,
        substring(t, cast(least(x, y) as bigint) + 1, cast(greatest(x, y) - least(x, y) as bigint)) as m, substring(t, cast(greatest(x, y) as bigint) + 1) as s
    from r)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
    sha256(case form when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else t end) as output_sha256,
    sha256(t) as restored_sha256
from c
""",
}
