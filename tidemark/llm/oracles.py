"""DuckDB SQL for the operators whose exact results SQL can express; plain and quadratic, for small tables."""

#: All pairs that share a shingle, then the transitive closure of the links.
NEAR_DEDUP = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents
), s as (
  select doc_id, case when len(words) >= 5 then list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) when len(words) > 0 then [array_to_string(words, ' ')] else [] end as shingles from w
), e as (
  select doc_id, unnest(shingles) as shingle, len(shingles) as n from s
), p as (
  select a.doc_id as x, b.doc_id as y from e a join e b on a.shingle = b.shingle and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
), r as (
  select x, y from p union select r.x, p.y from r join p on r.y = p.x
), c as (
  select x, min(y) as m from r group by x
)
select s.doc_id, cast(len(shingles) as bigint) as n_shingles, least(s.doc_id, coalesce(m, s.doc_id)) as component_id, s.doc_id <= coalesce(m, s.doc_id) as kept
from s left join c on c.x = s.doc_id
"""

#: Every window of 200 bytes (400 hex digits) by its digest; what repeats is cut out byte by byte.
REPEATS = r"""
with d as (
  select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents
), b as (
  select r, unnest(range(1, cast(length(h) / 2 as bigint) + 1)) as i from d
), w as (
  select b.r, i, md5(substr(h, 2 * i - 1, 400)) as m from b join d using (r) where i + 199 <= length(h) / 2
), k as (
  select r, i from (select r, i, count(*) over (partition by m) as n from w) where n > 1
), f as (
  select b.r, b.i, coalesce(max(k.i) over (partition by b.r order by b.i), -1000) + 200 > b.i as gone from b left join k on k.r = b.r and k.i = b.i
), t as (
  select *, gone and not coalesce(lag(gone) over (partition by r order by i), false) as first from f
), a as (
  select t.r, count(*) filter (where gone) as n_removed, count(*) filter (where first) as n_spans, string_agg(substr(h, 2 * i - 1, 2), '' order by i) filter (where not gone) as kept from t join d using (r) group by t.r
)
select doc_id, cast(length(h) / 2 as bigint) as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, ''))) as kept_sha256
from d left join a using (r)
"""

#: All pairs of one label, then the transitive closure of the links.
VECTORS = r"""
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as e from embeddings
), g as (
  select * from v where label is not null and e is not null and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0
), p as (
  select a.vec_id as x, b.vec_id as y from g a join g b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.98
), r as (
  select x, y from p union select r.x, p.y from r join p on r.y = p.x
), c as (
  select x, min(y) as m from r group by x
), n as (
  select x, count(*) as n_links from p group by x
)
select v.vec_id, coalesce(n_links, 0) as n_links, least(v.vec_id, coalesce(m, v.vec_id)) as component_id, v.vec_id <= coalesce(m, v.vec_id) as kept
from v left join c on c.x = v.vec_id left join n on n.x = v.vec_id
"""
