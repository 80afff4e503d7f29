"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

URL_FILTER = r"""
with parts as (
  select page_id,
         case when strpos(coalesce(url, ''), '://') = 0 then null
              else substr(url, strpos(url, '://') + 3) end as rest
  from pages),
cut as (
  select page_id, rest, coalesce(length(regexp_extract(rest, '^[^/?#]*')), 0) as n from parts),
named as (
  select page_id,
         coalesce(translate(left(rest, n), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(substr(rest, n + 1), '^[^?#]*'), '') as path
  from cut),
outcome as (
  select doc_id, min(case when quality > 0 then 1 else 0 end) as good
  from labels where doc_id is not null and quality is not null group by doc_id),
hosts as (
  select host, count(good) as n, coalesce(sum(good), 0)::bigint as good,
         case when len(string_split(host, '.')) > 1
              then string_split(host, '.')[-2] || '.' || string_split(host, '.')[-1] else host end as domain,
         string_split(host, '.')[-1] as suffix
  from named left join outcome on page_id = doc_id group by host),
whole as (select (sum(good) + 1) / (sum(n) + 2) as p from hosts),
sites as (select domain, sum(n)::bigint as n, sum(good)::bigint as good from hosts where n > 0 group by domain),
sums as (
  select count(*) as k, sum(n) as n, sum(good) as g, sum(good * good * 1000 // n) as q, sum(n * n) as w,
         sum(good) / sum(n) as p from sites),
ratio as (
  select (q / 1000.0 - g * p - (k - 1) * (p * (1 - p)))
         / nullif(p * (1 - p) * (n - w / n - (k - 1)), 0) as r from sums),
prior as (
  select case when r is null or r = 0 then case when r = 0 then 1000.0 else 20.0 end
              when r < 0 then 1000.0
              else greatest(2.0, least(1000.0, round((1 - r) / r))) end as m
  from (select (select r from ratio) as r)),
suffixes as (
  select suffix, (sum(good) + (select m from prior) * (select p from whole)) / (sum(n) + (select m from prior)) as sp
  from hosts group by suffix),
domains as (
  select domain, (sum(good) + (select m from prior) * any_value(sp)) / (sum(n) + (select m from prior)) as dp
  from hosts join suffixes using (suffix) group by domain),
means as (
  select host, n, good, (good + (select m from prior) * dp) / (n + (select m from prior)) as p
  from hosts join domains using (domain)),
rules(rule, verdict) as (
  values ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'),
         ('net/es/', 'block'), ('net/fr/', 'block')),
fitting as (
  select host, path, max_by(rule, length(rule)) as rule, max_by(verdict, length(rule)) as verdict
  from (select distinct host, path from named)
  join rules on (host = split_part(rule, '/', 1) or ends_with(host, '.' || split_part(rule, '/', 1)))
            and starts_with(path, substr(rule, strpos(rule, '/')))
  group by host, path)
select page_id, host, path, rule,
       coalesce(verdict, case when p + 2.0 * sqrt(p * (1 - p) / (n + (select m from prior) + 1)) < 0.5
                              then 'block' else 'allow' end) as verdict,
       n as labelled, good
from named join means using (host) left join fitting using (host, path)
"""

NGRAM_JACCARD = r"""
with recursive copies as (
  select coalesce(text, '') as t, min(doc_id) as rep, count(*) as n from documents group by coalesce(text, '')),
words as (
  select rep, list_filter(regexp_split_to_array(lower(t), '\s+'), lambda x: x <> '') as w from copies),
grams as (
  select rep, unnest(list_distinct(
    case when len(w) = 0 then []::varchar[]
         when len(w) < 5 then [array_to_string(w, ' ')]
         else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)) as g
  from words),
sizes as (select rep, count(*) as k from grams group by rep),
pairs as (
  select a.rep as a, b.rep as b, count(*) as c
  from grams a join grams b on a.g = b.g and a.rep < b.rep group by all),
links as (
  select a, b from pairs join sizes sa on sa.rep = a join sizes sb on sb.rep = b
  where 5 * c >= 4 * (sa.k + sb.k - c)),
both_ways as (select a, b from links union all select b, a from links),
walk(node, root) as (
  select rep, rep from copies
  union
  select b, root from walk join both_ways on a = node and root < b),
classes as (select node, min(root) as class_id from walk group by node),
counted as (
  select a as rep, count(*) as n_links, sum(n)::bigint as n_linked_docs
  from both_ways join copies on copies.rep = b group by a)
select doc_id, class_id, copies.rep as copy_id, n as n_copies,
       coalesce(n_links, 0) as n_links, coalesce(n_linked_docs, 0) as n_linked_docs
from documents
join copies on t = coalesce(text, '')
join classes on node = copies.rep
left join counted on counted.rep = copies.rep
where doc_id is not null
"""


def _share(pattern: str) -> str:
    return f"1000 * length(regexp_replace(t, '[^{pattern}]', '', 'g')) // greatest(strlen(t), 1)"


def _strength(source: str) -> str:
    """Moment estimate of what a parent's mean is worth, from (n, good) per site."""
    return f"""
    select case when r is null then 20.0 when r <= 0 then 1000.0
                else greatest(2.0, least(1000.0, round((1 - r) / r))) end as m
    from (select (q / 1000.0 - g * p - (k - 1) * (p * (1 - p)))
                 / nullif(p * (1 - p) * (n - w / n - (k - 1)), 0) as r
          from (select count(*) as k, sum(n) as n, sum(good) as g, sum(good * good * 1000 // n) as q,
                       sum(n * n) as w, sum(good) / sum(n) as p
                from (select n::bigint as n, good::bigint as good from ({source}))))"""


_CLASS_PATTERNS = {
    "symbols": r"#$%&*@^~=+<>{}\[\]\\_`",
    "bars": "|",
    "marks": "!?",
    "stops": ".,;:",
    "capitals": "A-Z",
    "digits": "0-9",
    "spaces": r" \t\n\r\x0b\x0c",
}
_RUNS = "|".join(rf"\{c}\{c}+" for c in "#$%&*!?@^~=+<>|")
_EDGES = (1, 2, 5, 10, 20, 40, 80, 160, 320, 640)
_WORD_EDGES = (50, 100, 200, 300, 400, 500, 600, 700, 800, 900)
_REPEAT_EDGES = (1, 5, 10, 20, 50, 100, 200, 400, 600, 800)
_VALUES = {
    **{f: (_share(p), _EDGES) for f, p in _CLASS_PATTERNS.items()},
    "runs": (f"1000 * len(regexp_extract_all(t, '{_RUNS}')) // greatest(strlen(t), 1)", _EDGES),
    "distinct": ("1000 * len(list_distinct(w)) // greatest(len(w), 1)", _WORD_EDGES),
    "repeats": (
        "1000 * len(list_filter(list_zip(w[1:len(w) - 1], w[2:]), lambda p: p[1] = p[2])) "
        "// greatest(len(w), 1)",
        _REPEAT_EDGES,
    ),
}
_BINS = ", ".join(
    f"{{'f': '{f}', 'b': len(list_filter({list(edges)}, lambda e: e <= v_{f}))}}"
    for f, (_, edges) in _VALUES.items()
)

QUALITY = rf"""
with texts as (
  select doc_id, coalesce(source, '') as host, coalesce(lang, '') as path, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\x0b\x0c]+') as w
  from documents),
valued as (
  select doc_id, host, path, {", ".join(f"{e} as v_{f}" for f, (e, _) in _VALUES.items())} from texts),
binned as (select doc_id, host, path, unnest([{_BINS}]) as x from valued),
outcome as (
  select doc_id, min(case when quality > 0 then 1 else 0 end) as good
  from labels where doc_id is not null and quality is not null group by doc_id),
labelled as (select host, path, good from documents d join outcome using (doc_id)
             join lateral (select coalesce(d.source, '') as host, coalesce(d.lang, '') as path) on true),
total as (select count(*) as n, coalesce(sum(good), 0) as g from labelled),
weights as (
  select x.f as f, x.b as b,
         round(500000 * ln(((sum(good) + 0.5) / ((select g from total) + 0.5 * 11))
                           / ((count(*) - sum(good) + 0.5) / ((select n - g from total) + 0.5 * 11))))::bigint as weight
  from binned join outcome using (doc_id) group by 1, 2),
scored as (
  select doc_id, host, path, sum(coalesce(weight, 0))::bigint as evidence
  from binned left join weights on x.f = f and x.b = b group by doc_id, host, path),
paths as (select host, path, count(*) as n, sum(good)::bigint as good from labelled group by 1, 2),
hosts as (select host, sum(n)::bigint as n, sum(good)::bigint as good from paths group by 1),
whole as (select (sum(good) + 1) / (sum(n) + 2) as p from paths),
of_hosts as ({_strength("select n, good from hosts")}),
of_paths as ({_strength("select n, good from paths")}),
host_means as (
  select host, (good + (select m from of_hosts) * (select p from whole)) / (n + (select m from of_hosts)) as hp from hosts),
path_means as (
  select host, path, (good + (select m from of_paths) * hp) / (n + (select m from of_paths)) as pp
  from paths join host_means using (host)),
judged as (
  select doc_id, host, path, evidence,
         round(1000000 * ln(coalesce(pp, hp, (select p from whole))
                            / (1 - coalesce(pp, hp, (select p from whole)))))::bigint as site_log_odds
  from scored left join path_means using (host, path) left join host_means using (host))
select *, evidence + site_log_odds as log_odds, evidence + site_log_odds >= 0 as keep from judged
"""

ORACLES: dict[str, str] = {
    "op1_quality_classifier": QUALITY,
    "op8_ngram_jaccard_join": NGRAM_JACCARD,
    "op9_url_filter": URL_FILTER,
}
