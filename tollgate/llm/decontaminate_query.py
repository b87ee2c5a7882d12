"""Query op6: benchmark windows in all documents, and its SQL."""

from __future__ import annotations

from tollgate.llm import decontaminate as D
from tollgate.llm.common import read_table


def op6_decontaminate(spark, sf_dir):
    return D.digest(D.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), size=10))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"[x for x in string_split_regex({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if x <> '']"

SQL = f"""
with items as (select item_id, {_WORDS} as w from benchmark),
windows as (
  select item_id, array_to_string(w[i : i + 9], ' ') as k, len(w[i : i + 9]) as size
  from (select item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as i from items where len(w) > 0)),
docs as (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
sizes as (select distinct size from windows),
spans as (
  select rid, i, size, array_to_string(w[i : i + size - 1], ' ') as k
  from (select rid, w, size, unnest(range(1, len(w) - size + 2)) as i from docs, sizes where len(w) >= size)),
found as (select s.rid, s.i, s.size, item_id from spans s join windows using (k, size)),
hit as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + size)) as p from found) group by rid),
named as (
  select rid, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct rid, cast(item_id as varchar) as id from found where item_id is not null) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (rid) left join named using (rid)
"""
