"""Query op12: all documents over 40 shards, and its SQL."""

from __future__ import annotations

from tollgate.llm import sharding
from tollgate.llm.common import read_table

#: Regions, racks in each, shards in each.
SHAPE = (5, 2, 4)


def op12_shard_tree(spark, sf_dir):
    tree = sharding.Tree.uniform(*SHAPE)
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), tree, tree.with_region([[1.0]]))


def _draw_sql(src: str, path: str, children: str, out: str) -> str:
    """Rows of ``src`` with the child of least variate; ``children`` lists (index, weight)."""
    u = f"(('0x' || substr(md5(k || '|' || {path} || '/' || i), 1, {sharding.DIGITS}))::BIGINT + 0.5) / {16 ** sharding.DIGITS}.0"
    return f"""select {src}.*, arg_min(i, -ln({u}) / w) as {out} from {src} join (values {children}) c(i, w) on true group by all"""


def _place_sql(grown: bool) -> str:
    regions, racks, shards = SHAPE
    n = racks * shards
    top = [(i, n) for i in range(regions)] + ([(regions, 1)] if grown else [])
    name = "grown_shard" if grown else "shard"
    text = lambda pairs: ", ".join(f"({i}, {float(w)})" for i, w in pairs)
    # The added region has one shard, which needs no draw.
    return f"""
a_{name} as ({_draw_sql('keys', "''", text(top), 'r')}),
b_{name} as ({_draw_sql(f'a_{name}', 'r', text((i, shards) for i in range(racks)), 'a')}),
c_{name} as ({_draw_sql(f'b_{name}', "r || '/' || a", text((i, 1) for i in range(shards)), 's')}),
{name}s as (select k, cast(case when r = {regions} then {regions * n} else r * {n} + a * {shards} + s end as int) as {name} from c_{name})"""


#: crc32 by table lookup over the text's bytes.
SQL = f"""
with recursive table_of as (
  select i, list_reduce([cast(i as bigint), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
  from range(256) t(i)),
crc_table as (select list(v order by i) as t from table_of),
docs as (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
texts as (select text, encode(text) as b, hex(encode(text)) as h from (select distinct text from docs)),
crcs as (
  select text, octet_length(b) + 16 as size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || substr(h, 2 * p + 1, 2))::BIGINT for p in range(octet_length(b))]),
      lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) as text_crc32
  from texts, crc_table),
keys as (select distinct coalesce(cast(doc_id as varchar), 'null:') as k from docs),
{_place_sql(False)},
{_place_sql(True)}
select doc_id, size, text_crc32, 'key' as law, shard,
  row_number() over (partition by shard order by doc_id nulls first, size, text_crc32) - 1 as slot, grown_shard
from docs join crcs using (text) join shards on shards.k = coalesce(cast(doc_id as varchar), 'null:')
  join grown_shards on grown_shards.k = shards.k
"""
