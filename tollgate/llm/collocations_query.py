"""Query op11: collocations of all documents, and its SQL."""

from __future__ import annotations

from tollgate.llm import collocations
from tollgate.llm.common import read_table


def op11_collocations(spark, sf_dir):
    return collocations.collocations(read_table(spark, sf_dir, "documents"), top=2000, min_count=10, cover=50)


SQL = """
with pieces as (
  select row_number() over () as piece, lang, regexp_extract_all(p, '[^\\x20\\x09]+') as w from (
    select coalesce(lang, 'und') as lang,
      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as p
    from documents)),
words as (select piece, lang, unnest(w) as x, unnest(range(len(w))) as i from pieces),
runs as (select lang, x, lead(x) over p as y, lead(x, 2) over p as z from words window p as (partition by piece order by i)),
one as (select lang, x, count(*) as a from runs group by all),
two as (select lang, x, y, count(*) as a from runs where y is not null group by all),
three as (select lang, x, y, z, count(*) as a from runs where z is not null group by all),
cuts as (
  select c.lang, c.x, c.y, null as z, c.a, 1 as k, l.a as l, r.a as r
  from two c join one l on l.lang = c.lang and l.x = c.x join one r on r.lang = c.lang and r.x = c.y where c.a >= 10
  union all
  select c.lang, c.x, c.y, c.z, c.a, 1, l.a, r.a
  from three c join one l on l.lang = c.lang and l.x = c.x join two r on r.lang = c.lang and r.x = c.y and r.y = c.z where c.a >= 10
  union all
  select c.lang, c.x, c.y, c.z, c.a, 2, l.a, r.a
  from three c join two l on l.lang = c.lang and l.x = c.x and l.y = c.y join one r on r.lang = c.lang and r.x = c.z where c.a >= 10),
scored as (select *, 1000000::HUGEINT * a * a // (l::HUGEINT * r) as score from cuts),
lowest as (select * from scored qualify row_number() over (partition by lang, x, y, z order by score, k) = 1),
inside as (
  select lang, x, y, max(a) as longest from (
    select lang, x, y, a from three where a >= 10 union all select lang, y, z, a from three where a >= 10) group by all),
alive as (
  select lowest.lang, lowest.x || ' ' || lowest.y || coalesce(' ' || z, '') as phrase, a, l, r, score
  from lowest left join inside on z is null and inside.lang = lowest.lang and inside.x = lowest.x and inside.y = lowest.y
  where longest is null or 100 * longest < 50 * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from alive),
sizes as (select lang, sum(a) as n from one group by lang)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score from ranked join sizes using (lang) where rank <= 2000
"""
