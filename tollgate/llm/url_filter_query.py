"""Query op3: every page's url under the rules, and its SQL."""

from __future__ import annotations

from tollgate.llm import url_filter as U
from tollgate.llm.common import read_table

RULES = [U.Rule.parse("block", "net/"), U.Rule.parse("allow", "example.net/en/"), U.Rule.parse("block", "example.com/de/"), U.Rule.parse("allow", "org/fr/")]


def op3_url_filter(spark, sf_dir):
    return U.verdicts(read_table(spark, sf_dir, "pages"), RULES)


_LINK = r"""coalesce(nullif(regexp_extract(t, '(?is)\shref\s*=\s*["'']?([^"''\s>]*)', 1), ''), nullif(regexp_extract(t, '(?is)url\s*=\s*''?([^"''\s>]*)', 1), ''))"""

_RULED = """
  (select {keys}, h, p, r.verdict as rule_verdict, r.host || r.path as rule,
     row_number() over (partition by {part} order by length(r.host || r.path) desc nulls last, r.verdict, r.host || r.path) as k
   from {src} left join rules r on (h = r.host or ends_with(h, '.' || r.host)) and starts_with(p, r.path))
"""

#: Absolute links only differ from others by resolution, done here in a macro-free way.
SQL = rf"""
with recursive rules(verdict, host, path) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
parsed as (
  select row_number() over () as rid, page_id, url, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{U.UPPER}', '{U.LOWER}') as h,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as p,
    regexp_extract(url, '(?s)^.*?://[^?#]*(\?[^#]*)?', 1) as q
  from pages),
nodes as (select *, case when contains(url, '://') then h || (case when p = '' then '/' else p end) || coalesce(q, '') end as own from parsed),
tags as (
  select own, url, p, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\s[^>]*>')) as t from nodes where own is not null),
hrefs as (
  select own, url, p, {_LINK} as href from tags
  where (regexp_matches(t, '(?is)^<link') and regexp_matches(t, '(?is)\srel\s*=\s*["'']?canonical["''\s/>]'))
     or (regexp_matches(t, '(?is)^<meta') and regexp_matches(t, '(?is)\shttp-equiv\s*=\s*["'']?refresh["''\s/>]'))),
targets as (
  select own, case
    when regexp_matches(href, '(?i)^[a-z][a-z0-9+.-]*://') then href
    when starts_with(href, '//') then regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || href
    when starts_with(href, '/') then regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || href
    when regexp_matches(href, '(?i)^[a-z][a-z0-9+.-]*:') then null
    when href = '' or starts_with(href, '#') then url
    else regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || (case when regexp_replace(p, '[^/]*$', '') = '' then '/' else regexp_replace(p, '[^/]*$', '') end) || href end as u
  from hrefs where href is not null),
edges as (
  select own as a, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), '{U.UPPER}', '{U.LOWER}')
    || (case when regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) = '' then '/' else regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) end)
    || coalesce(regexp_extract(u, '(?s)^.*?://[^?#]*(\?[^#]*)?', 1), '') as b
  from targets where contains(u, '://')),
both_ways as (select a, b from edges where a <> b union select b, a from edges where a <> b),
reach(node, other) as (select a, a from both_ways union select r.node, e.b from reach r join both_ways e on r.other = e.a),
comp as (select node, min(other) as root from reach group by node),
comp_urls as (
  select node, root, regexp_extract(node, '^([^/?#]*)', 1) as h, regexp_extract('x://' || node, '(?s)^.*?://[^/?#]*([^?#]*)', 1) as p from comp),
ruled_nodes as (select * from {_RULED.format(keys='node, root', part='node', src='comp_urls')} where k = 1),
roots as (select root, bool_or(rule_verdict = 'allow') as allowed, bool_or(rule_verdict = 'block') as blocked from ruled_nodes group by root),
passed as (select node, root, coalesce(blocked, false) and not coalesce(allowed, false) as tainted from comp join roots using (root)),
ruled as (select * from {_RULED.format(keys='rid, page_id, own', part='rid', src='nodes')} where k = 1)
select page_id, h as host, p as path, rule,
  coalesce(rule_verdict, case when tainted then 'block' end, 'allow') as verdict, root as alias_of
from ruled left join passed on ruled.own = passed.node
"""
