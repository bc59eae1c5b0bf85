"""DuckDB SQL for the operators that SQL can express; the others are held against brute force in tests/llm."""

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = rf"""
with recursive words as (
  select doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') as w from documents
),
places as (
  select doc_id, w, len(w) as n, unnest(generate_series(1, greatest(1, len(w) - 4))) as p from words where len(w) > 0
),
shingles as (select distinct doc_id, md5(array_to_string(w[p : p + least(n, 5) - 1], ' ')) as s from places),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n_both
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2
),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * n_both >= 85 * (x.n + y.n - n_both)
),
reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reach r join links l on r.b = l.a
),
least_id as (select a as doc_id, min(b) as component_id from reach group by a)
select d.doc_id, coalesce(s.n, 0) as n_shingles, l.component_id, d.doc_id = l.component_id as kept
from documents d left join sizes s using (doc_id) join least_id l using (doc_id)
"""

OP9 = rf"""
with doc_words as (select doc_id, regexp_extract_all({LOWERED}, '{WORD}') as w from documents),
item_words as (select item_id, regexp_extract_all({LOWERED}, '{WORD}') as w from benchmark),
windows as (
  select distinct item_id, array_to_string(w[p : p + 9], ' ') as phrase, least(len(w), 10) as n
  from (select item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) as p from item_words where len(w) > 0)
),
lengths as (select distinct n from windows),
places as (
  select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as p from doc_words, lengths where len(w) >= n
),
hits as (
  select doc_id, places.p, places.n, item_id
  from places join windows on windows.n = places.n and windows.phrase = array_to_string(w[p : p + places.n - 1], ' ')
),
covered as (
  select doc_id, count(distinct spot) as n_hit from (select doc_id, unnest(generate_series(p, p + n - 1)) as spot from hits) group by doc_id
),
found as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
  from (select distinct doc_id, cast(item_id as varchar) as item_id from hits) group by doc_id
)
select d.doc_id, len(d.w) as n_words, coalesce(c.n_hit, 0) as n_hit, coalesce(f.n_items, 0) as n_items,
  sha256(coalesce(f.items, '')) as items_sha256, coalesce(c.n_hit, 0) > 0 as contaminated
from doc_words d left join covered c using (doc_id) left join found f using (doc_id)
"""

OP10 = """
with logged as (
  select conv_id, list(struct_pack(turn := turn, role := role, text := text) order by turn, role, text) as turns
  from (select distinct conv_id, turn, role, text from conversations) group by conv_id
),
kept as (
  select a.conv_id, a.turns from logged a where not exists (
    select 1 from logged b
    where b.turns[1] = a.turns[1] and b.turns[1 : len(a.turns)] = a.turns
      and (len(b.turns) > len(a.turns) or b.conv_id < a.conv_id)
  )
),
each as (select conv_id, len(turns) as n, unnest(turns) as t, generate_subscripts(turns, 1) as place from kept)
select conv_id, (place - 1) // 1000 as part, (n + 999) // 1000 as n_parts, count(*) as n_turns,
  string_agg('<|' || coalesce(t.role, '') || '|>' || chr(10) || coalesce(t.text, '') || '<|end|>' || chr(10), ''
    order by t.turn, t.role, t.text) as rendered
from each group by 1, 2, 3
"""

SQL = {"op4_near_duplicates": OP4, "op9_decontamination": OP9, "op10_chat_format": OP10}
