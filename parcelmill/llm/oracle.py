"""The registered queries as DuckDB SQL over the driver tables, where SQL can express them."""

from __future__ import annotations

ORACLE: dict[str, str] = {}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE["op6_benchmark_decontamination"] = rf"""
with d as (
    select row_number() over () as r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents),
b as (
    select item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark where item_id is not null and text is not null),
bw as (
    select distinct item_id, least(10, len(w)) as k, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as g
    from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0)),
dw as (
    select r, k, i, array_to_string(w[i : i + k - 1], ' ') as g
    from (select r, w, k, unnest(range(1, len(w) - k + 2)) as i from d, (select distinct k from bw) where len(w) >= k)),
h as (select r, i, dw.k, item_id from dw join bw on dw.k = bw.k and dw.g = bw.g),
n as (select r, count(*) as n_hit from (select distinct r, unnest(range(i, i + k)) as word from h) group by r),
t as (select r, count(*) as n_items, string_agg(s, ',' order by s) as s from (select distinct r, item_id::varchar as s from h) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (r) left join t using (r)"""

ORACLE["op9_minhash_near_dedup"] = rf"""
with recursive d as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') as w from documents),
s as materialized (
    select distinct doc_id, hash(g) as g, g as words
    from (select doc_id, array_to_string(w[i : i + least(4, len(w)) - 1], ' ') as g
          from (select doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) as i from d where len(w) > 0))),
n as materialized (select doc_id, count(*) as n from s group by doc_id),
c as (
    select a.doc_id as x, b.doc_id as y, count(*) as common
    from s a join s b on a.g = b.g and a.words = b.words and a.doc_id < b.doc_id group by all),
l as materialized (
    select x, y from c join n p on p.doc_id = x join n q on q.doc_id = y where 100 * common >= 80 * (p.n + q.n - common)),
e as materialized (select x, y from l union select y, x from l),
r(doc_id, reached) as (select doc_id, doc_id from d union select r.doc_id, e.y from r join e on e.x = r.reached),
k as (select doc_id, min(reached) as component_id from r group by doc_id)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
from k left join n using (doc_id)"""

ORACLE["op8_warc"] = """
with p as (select row_number() over () as r, page_id, encode(coalesce(html, '')) as b from pages),
s as (select r, page_id, octet_length(b)::bigint as n, sha1(b) as sha from p),
g as (select sha, max(page_id) as last from s where n >= 1000 and page_id is not null group by sha)
select page_id, n as payload_bytes, s.sha as payload_digest,
    case when page_id < last and n >= 1000 then 'revisit' else 'response' end as record_type,
    case when page_id < last and n >= 1000 then last end as refers_to
from s left join g on s.sha = g.sha"""

ORACLE["op12_hard_negative_mining"] = """
with r as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as q
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
    select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same, list_dot_product(a.q, b.q)::bigint as score
    from r a join r b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 50 = 0),
p as (
    select anchor_id, other as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select p.anchor_id, positive_id, row_number() over (partition by p.anchor_id, positive_id order by score desc, other)::int as rank,
    other as negative_id, positive_score, score as negative_score
from p join s on s.anchor_id = p.anchor_id and not same and 100 * score between 50 * positive_score and 95 * positive_score
qualify row_number() over (partition by p.anchor_id, positive_id order by score desc, other) <= 3"""
