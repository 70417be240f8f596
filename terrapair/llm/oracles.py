"""DuckDB SQL for operators that SQL can express on whole tables."""

WORDS = r"[^\x20\x09-\x0D]+"
ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = rf"""
with recursive w as materialized (select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{WORDS}') as ws from documents),
s as materialized (
  select doc_id, hash(sh) as sh from (
    select distinct doc_id, array_to_string(ws[i:i + 3], ' ') as sh from (select doc_id, ws, unnest(range(1, len(ws) - 2)) as i from w where len(ws) >= 4)
    union all select doc_id, array_to_string(ws, ' ') || ' ' from w where len(ws) between 1 and 3)),
n as materialized (select doc_id, count(*) as n from s group by 1),
links as materialized (
  select p.a, p.b from (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.sh = y.sh and x.doc_id <> y.doc_id group by 1, 2) p
  join n na on na.doc_id = p.a join n nb on nb.doc_id = p.b where 100 * c >= 85 * (na.n + nb.n - c)),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, least(w.doc_id, coalesce(m.b, w.doc_id)) as component_id
from w left join n on n.doc_id = w.doc_id left join (select a, min(b) as b from reach group by 1) m on m.a = w.doc_id
"""

CONTAMINATION = rf"""
with w as materialized (select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{ITEM_WORDS}') as ws from documents),
b as (select item_id::varchar as item, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{ITEM_WORDS}') as ws from benchmark),
grams as materialized (
  select distinct item, len(g) as k, array_to_string(g, ' ') as g from (
    select item, ws[i:i + 12] as g from (select item, ws, unnest(range(1, len(ws) - 11)) as i from b where len(ws) >= 13)
    union all select item, ws from b where len(ws) between 1 and 12)),
lengths as (select distinct k from grams),
spot as (select doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) as i from w, lengths where len(ws) >= k),
hits as materialized (select a.doc_id, a.i, a.k, g.item from (select doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') as g from spot) a join grams g on g.k = a.k and g.g = a.g),
words as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(i, i + k)) as p from hits) group by 1),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct doc_id, item from hits) group by 1)
select w.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(names, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from w left join words on words.doc_id = w.doc_id left join items on items.doc_id = w.doc_id
"""

SUBSTRINGS = rf"""
with w as materialized (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') as ws from documents),
win as materialized (select doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) as h from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from w where len(ws) >= 50)),
first as (select h, min(doc_id) as m from win group by 1),
gone as (select distinct doc_id, unnest(range(i, i + 50)) as p from win join first using (h) where m < doc_id),
word as (select doc_id, unnest(ws) as x, unnest(range(1, len(ws) + 1)) as p from w),
kept as (select word.doc_id, count(gone.p) as n, string_agg(x, ' ' order by word.p) filter (where gone.p is null) as t from word left join gone on gone.doc_id = word.doc_id and gone.p = word.p group by 1)
select w.doc_id, len(ws)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256 from w left join kept on kept.doc_id = w.doc_id
"""
