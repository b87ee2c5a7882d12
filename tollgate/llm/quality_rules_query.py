"""Query op5: the rule ledger over all documents, and its SQL."""

from __future__ import annotations

from tollgate.llm import quality_rules as Q
from tollgate.llm.common import read_table

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_bits"]


def op5_quality_rules(spark, sf_dir):
    return Q.apply_policy(Q.ledger(read_table(spark, sf_dir, "documents"))).select(*COLUMNS)


def _bits_sql() -> str:
    return " + ".join(f"(case when {r.fails} then {1 << i} else 0 end)" for i, r in enumerate(Q.RULES))


#: Word positions are joined to the repeated windows that cover them.
SQL = f"""
with w0 as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
         [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\\x20\\x09-\\x0D]')] as l
  from documents),
tri as (
  select rid, unnest(range(1, len(w) - 1)) as i, w from w0 where len(w) >= 3),
keyed as (select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as k from tri),
twice as (select rid, i from (select rid, i, count(*) over (partition by rid, k) as c from keyed) where c > 1),
covered as (select rid, count(distinct p) as n from (select rid, unnest([i, i + 1, i + 2]) as p from twice) group by rid),
m as (
  select doc_id, cast(len(w) as bigint) as n_words,
    cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
    cast(coalesce(n, 0) as bigint) as n_repeat_words,
    cast(len(l) as bigint) as n_lines,
    cast(length(regexp_replace(text, '[^A-Z]', '', 'g')) as bigint) as n_capitals
  from w0 left join covered using (rid)),
b as (select *, cast({_bits_sql()} as bigint) as failed_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failed_bits & {Q.mask_of('base')}) <> 0 as base_failed,
  (failed_bits & {Q.mask_of(Q.CURRENT) | Q.mask_of('base')}) = 0 as kept, failed_bits
from b
"""
