"""DuckDB SQL for the queries that SQL can express, over whole tables."""

WORD = r"[^\x20\x09-\x0D]+"

OP1 = r"""
with recursive word as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
shingle as (
  select distinct doc_id, case when len(w) >= 5 then list_slice(w, i, i + 4) else w end as s
  from word, lateral (select unnest(range(1, greatest(len(w) - 3, 2))) as i) where len(w) > 0),
size as (select doc_id, count(*)::bigint as n from shingle group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as k from shingle a join shingle b on a.s = b.s and a.doc_id < b.doc_id group by x, y),
link as (
  select x, y from common join size p on p.doc_id = x join size q on q.doc_id = y where 100 * k >= 85 * (p.n + q.n - k)),
arc as (select x, y from link union all select y, x from link),
reach(doc_id, other) as (
  select doc_id, doc_id from documents
  union
  select r.doc_id, b.y from reach r join arc b on b.x = r.other),
component as (select doc_id, min(other) as component_id from reach group by doc_id)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
from documents left join size using (doc_id) left join component using (doc_id)
"""

OP9 = r"""
with raw as (select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents),
start as (
  select doc_id, k, md5_number(substr(h, (2 * k + 1)::int, 800)) as m
  from raw, lateral (select unnest(range(0, n - 399)) as k) where n >= 400),
hit as (select doc_id, k from start where m in (select m from start group by m having count(*) > 1)),
edge as (
  select doc_id, k, case when k > coalesce(lag(k) over (partition by doc_id order by k) + 400, -1) then 1 else 0 end as fresh from hit),
run as (select doc_id, k, sum(fresh) over (partition by doc_id order by k rows unbounded preceding) as r from edge),
span as (select doc_id, r, min(k) as a, max(k) + 400 as b from run group by doc_id, r),
gap as (   -- what is left before each span, and after the last one
  select doc_id, a, coalesce(lag(b) over (partition by doc_id order by a), 0) as z from span),
kept as (
  select doc_id, string_agg(substr(h, (2 * z + 1)::int, (2 * (a - z))::int), '' order by a) as t
  from (select doc_id, a, z from gap
        union all select r.doc_id, r.n, coalesce(max(s.b), 0) from raw r left join span s on s.doc_id = r.doc_id group by r.doc_id, r.n) p
  join raw using (doc_id) group by doc_id)
select raw.doc_id, n::bigint as n_bytes, coalesce((select sum(b - a) from span s where s.doc_id = raw.doc_id), 0)::bigint as n_removed,
  (select count(*) from span s where s.doc_id = raw.doc_id)::bigint as n_spans, sha256(unhex(t)) as kept_sha256
from raw join kept using (doc_id)
"""

OP3 = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
binned as (
  select *, length(bin(size)) * 16
    + list_sum([('0' || substr(rpad(bin(size), 4, '0'), i, 1))::int * (1 << (4 - i)) for i in [1, 2, 3, 4]]) as class,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 8))::bigint as h
  from sized),
per_source as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as nr
  from binned group by source),
weighed as (
  select *, [5.0::double, 2.0::double, 1.0::double][((nr - 1) % 3 + 1)::int] as w, 3.0::double * source_size as cap
  from per_source),
levels as (
  select *, cap / w as ratio,
    ((sum(source_size) over ())::double
      - coalesce(sum(cap) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0.0))
    / sum(w) over (order by cap / w, source nulls last rows between current row and unbounded following) as level_here
  from weighed),
one_level as (select max(level_here) as level from levels),
goals as (
  select source, source_size,
    case when ratio < level then cap else least(w * level, cap) end as target,
    ('0x' || substr(md5('20|' || case when source is null then 'n' else 's' || source end), 1, 8))::bigint
      / 4294967296.0::double as u
  from levels, one_level),
slots as (select source, class, ceil(sqrt(count(*)))::bigint as slots from binned group by source, class),
ranked as (
  select b.doc_id, b.size, b.source,
    row_number() over (partition by b.source order by b.class, b.h % s.slots, b.size, b.doc_id) as place
  from binned b join slots s on b.source is not distinct from s.source and b.class = s.class),
rated as (
  select r.*, g.source_size, g.target, g.u,
    case when g.source_size > 0 then g.target / g.source_size else 0.0 end as rate
  from ranked r join goals g on r.source is not distinct from g.source)
select doc_id, size, source_size, target,
  (least(floor(rate * place + u) - floor(rate * (place - 1) + u), 3) * size)::bigint as taken
from rated
"""

OP4 = r"""
with line as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from line),
frequent as (select k from keyed where k <> '' group by k having count(distinct doc_id) >= 10)
select doc_id, count(*)::bigint as n_lines, count(*) filter (where f.k is not null)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where f.k is null), '')) as kept_sha256
from keyed left join frequent f using (k) group by doc_id
"""

OP7 = r"""
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
scored as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from (from v where vec_id % 100 = 0) q join v c on c.vec_id <> q.vec_id and len(c.v) = len(q.v)),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""

OP12 = r"""
with split as (
  select row_number() over () as row, doc_id, translate(unnest(regexp_extract_all(text,
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term
  from documents),
docs as (select row, doc_id, count(*)::bigint as n from split group by row, doc_id),
total as (select count(*)::bigint as nn, sum(n)::bigint as l from docs),
post as (select row, term, count(*)::bigint as tf from split group by row, term),
item as (
  select item_id, text, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term
  from (select distinct item_id, text from benchmark)),
asked as (select item_id, text, term, count(*)::bigint as times from item group by all),
weighed as (
  select term, floor(1000 * ln((2 * nn + 2)::double / (2 * df + 1)::double))::bigint as w
  from (select term, count(*)::bigint as df from post where term in (select term from asked) group by term), total),
scored as (
  select item_id, a.text, d.doc_id, d.row,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // l))))::bigint as score
  from asked a join weighed using (term) join post p using (term) join docs d on d.row = p.row, total
  group by item_id, a.text, d.doc_id, d.row),
ranked as (
  select *, row_number() over (partition by item_id, text order by score desc, doc_id)::int as rank from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""

OP13 = r"""
with recursive firsts as (select coalesce(text, '') as t, min(doc_id) as first from documents group by 1),
label as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by 1),
split as (
  select d.doc_id, d.lang, coalesce(d.text, '') as t, regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+') as w
  from documents d),
failing as (
  select coalesce(s.lang, '') as part, coalesce(l.good, false) as good, coalesce(l.toxic, false) as toxic,
    list_filter([
      case when len(w) < 100 then 'A' end,
      case when 100 * len(list_distinct(w)) < 80 * len(w) then 'B' end,
      case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) then 'C' end,
      case when regexp_matches(t, '[#$%&*|]') then 'D' end,
      case when s.doc_id > f.first then 'E' end], lambda x: x is not null) as bad
  from split s join firsts f using (t) left join label l on l.doc_id = s.doc_id),
orders(o, rest) as (
  select '', 'ABCDE'
  union all
  select o || substr(rest, i::int, 1), substr(rest, 1, i::int - 1) || substr(rest, i::int + 1)
  from orders, range(1, 6) r(i) where i <= length(rest)),
steps as (
  select o as filter_order, s::int as step, substr(o, s::int, 1) as f, substr(o, 1, s::int - 1) as before
  from orders, range(1, 6) r(s) where rest = ''),
classes as (
  select part, bad, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic
  from failing group by part, bad),
met as (
  select part, filter_order, step, f, n, good, toxic, bad, list_contains(bad, f) as fails,
    len(list_filter(bad, lambda x: contains(before, x))) > 0 as gone
  from classes, steps),
counted as (
  select part, filter_order, step, f,
    sum(case when not gone and not fails then n else 0 end)::bigint as kept,
    sum(case when not gone and fails then n else 0 end)::bigint as removed,
    sum(case when gone and fails then n else 0 end)::bigint as redundant,
    sum(case when bad = [f] then n else 0 end)::bigint as unique_fails,
    sum(case when not gone and fails then good else 0 end)::bigint as good_lost,
    sum(case when not gone and fails then toxic else 0 end)::bigint as toxic_lost
  from met group by part, filter_order, step, f)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, f))::bigint as shapley
from counted
"""

SQL = {"op1_hyperminhash": OP1, "op9_sparse_suffixes": OP9, "op3_systematic_mix": OP3, "op4_line_dedup": OP4, "op7_ball_tree": OP7,
       "op12_block_max_search": OP12, "op13_filter_audit": OP13}
