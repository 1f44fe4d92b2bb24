"""DuckDB SQL of the queries that SQL can express."""

WORDS = r"'[^\x20\x09-\x0D]+'"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NGRAM_JOIN = f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {WORDS}) as w from documents),
s as (
  select doc_id, list_distinct(case when len(w) >= 5
    then [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as grams from w),
g as (select doc_id, len(grams) as n, unnest(grams) as gram from s),
l as (
  select a.doc_id as a, b.doc_id as b from g a join g b on a.gram = b.gram and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r as (
  select doc_id as id, doc_id as root from documents
  union select l.b, r.root from r join l on l.a = r.id)
select doc_id, cast(len(grams) as bigint) as n_shingles, root as component_id
from s join (select id, min(root) as root from r group by id) on id = doc_id
"""

MIX = f"""
with d as (
  select doc_id, source, md5('0:' || coalesce(cast(doc_id as varchar), '')) as name,
         cast(coalesce(len(regexp_extract_all(text, {WORDS})), 0) as bigint) as size from documents),
b as (select *, greatest(0, length(bin(size)) - 7) as cut from d),
o as (
  select *, row_number() over (
    partition by source
    order by (size >> cut) << cut, cast('0x' || substr(name, 1, 4) as integer) % 16, size, name, doc_id) as n
  from b),
t as (
  select source, cast(sum(size) as bigint) as source_size,
         cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as bigint) as weight
  from d group by source),
c as (select *, 3 * source_size as most, 3.0 * source_size / weight as ratio from t),
p as (
  select *, sum(source_size) over () as whole,
         coalesce(sum(most) over (order by ratio, weight, source rows between unbounded preceding and 1 preceding), 0) as given,
         sum(weight) over (order by ratio, weight, source rows between current row and unbounded following) as open
  from c),
v as (
  select cast(whole - given as double) / cast(open as double) as level from p
  where cast(whole - given as double) / cast(open as double) <= ratio order by ratio, weight, source limit 1),
m as (
  select source, source_size, least(cast(most as double), weight * level) as target,
         cast(cast('0x' || substr(md5('0:' || coalesce(source, '')), 1, 8) as bigint) as double) / 4294967296.0::double as start
  from c, v),
x as (
  select o.*, m.source_size, m.target, m.start, case when m.source_size > 0 then m.target / m.source_size else 0 end as rate
  from o join m on o.source is not distinct from m.source)
select doc_id, size, source_size, target,
       cast(size * (floor(n * rate + start) - floor((n - 1) * rate + start)) as bigint) as taken
from x
"""
