"""DuckDB statements that say what each registered query must return.

They are written from the rules of the models, not from the DataFrame code, with one more sort
key wherever the rule alone leaves ties.
"""

from __future__ import annotations

import re

from cotag.operators import extract
from cotag.verify import fixtures as fx

_BRANDS = "'brand#1', 'brand#2'"
_N = len(fx.BRANDS)
_DAY = f"DATE '{fx.TARGET_DAY}'"

# Named parts in the order in which they build on each other.
_PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "posts": ((), fx.for_duckdb(fx.POSTS_SQL)),
    "batch": ((), fx.for_duckdb(fx.BATCH_SQL)),
    "bad_batch": ((), fx.for_duckdb(fx.BAD_BATCH_SQL)),
    "fetched": ((), fx.for_duckdb(fx.FETCHED_SQL)),
    "profiles": ((), fx.for_duckdb(fx.PROFILES_SQL)),
    "brand_records": ((), fx.for_duckdb(fx.BRAND_RECORDS_SQL)),
    "grids": ((), fx.for_duckdb(fx.GRIDS_SQL)),
    "details": ((), fx.for_duckdb(fx.DETAILS_SQL)),
    "snapshots": (("grids",), fx.SNAPSHOTS_SQL.replace("{grids}", "grids")),
    "parts": (
        ("posts",),
        """
select p.post_id, p.insta_id, p.insta_name, p.brand_name, p.brand_id, p.post_date, p.full_link,
       u.tag_pos, trim(u.part) as part
from posts p cross join unnest(string_split(p.tagged_insta_id, ',')) with ordinality
     as u(part, tag_pos)
where trim(p.tagged_insta_id) <> ''
""",
    ),
    "stage": (
        ("parts",),
        """
select md5(concat_ws('||', post_id, cast(tag_pos as varchar), account)) as pk_tagged_post,
       tag_pos, post_id, insta_id, insta_name, brand_name, brand_id, post_date, full_link,
       account as tagged_account
from (select *, lower(rtrim(regexp_replace(part, '^@', ''), '.')) as account
      from parts where part <> '')
""",
    ),
    "edges": (
        ("stage",),
        """
select insta_id, tagged_account,
       coalesce(max(insta_name) filter (where insta_name <> 'unknown'), 'unknown') as insta_name,
       min(post_date) as first_tagged_date, max(post_date) as last_tagged_date,
       count(distinct post_id) as tagged_post_count
from stage group by insta_id, tagged_account
""",
    ),
    "cross_brand": (
        ("edges",),
        """
select insta_id,
       coalesce(max(insta_name) filter (where insta_name <> 'unknown'), 'unknown') as insta_name,
       count(*) as tagged_account_count,
       string_agg(tagged_account, ', ' order by tagged_account) as brands_tagged
from edges group by insta_id
""",
    ),
    "monthly": (
        ("stage",),
        """
select tagged_account, cast(date_trunc('month', post_date) as date) as month,
       count(distinct insta_id) as unique_tagger_count, count(distinct post_id) as post_count
from stage group by all
""",
    ),
    "tagger_months": (
        ("stage",),
        """
select tagged_account, cast(date_trunc('month', post_date) as date) as month, insta_id,
       count(distinct post_id) as post_count
from stage group by all
""",
    ),
    "recent": (
        ("posts",),
        """
select insta_id, post_id, post_date, tagged_insta_id, full_link from posts
qualify row_number() over (partition by insta_id order by post_date desc, post_id) <= 10
""",
    ),
    "stats": (
        ("edges",),
        """
select tagged_account, count(distinct insta_id) as tagger_count,
       cast(sum(tagged_post_count) as bigint) as total_tag_count,
       round(count(distinct insta_id) * 100.0
             / (select count(distinct insta_id) from edges), 1) as tagger_ratio
from edges group by tagged_account
""",
    ),
    "chosen": (
        ("edges",),
        f"""
select insta_id from edges where tagged_account in ({_BRANDS})
group by insta_id having count(distinct tagged_account) = {_N}
""",
    ),
    "own": (
        ("edges", "chosen"),
        f"""
select insta_id, coalesce(max(nullif(insta_name, 'unknown')), insta_id) as display_name,
       cast(sum(tagged_post_count) as bigint) as tag_count,
       max(last_tagged_date) as latest_tag_date
from edges semi join chosen using (insta_id)
where tagged_account in ({_BRANDS}) group by insta_id
""",
    ),
    "ranking": (
        ("edges", "chosen"),
        f"""
select row_number() over (order by tagger_count desc, total_tag_count desc, tagged_account) as rank,
       tagged_account, tagger_count, total_tag_count,
       round(tagger_count * 100.0 / (select count(*) from chosen), 1) as tagger_ratio
from (select tagged_account, count(distinct insta_id) as tagger_count,
             cast(sum(tagged_post_count) as bigint) as total_tag_count
      from edges semi join chosen using (insta_id)
      where tagged_account not in ({_BRANDS}) group by tagged_account)
""",
    ),
    "listed": (
        ("edges", "chosen"),
        f"""
select row_number() over (order by tag_count desc, latest_tag_date desc, insta_id) as rank, *
from (select a.insta_id, coalesce(max(nullif(a.insta_name, 'unknown')), a.insta_id) as insta_name,
             cast(sum(a.tagged_post_count) as bigint) as tag_count,
             max(a.last_tagged_date) as latest_tag_date,
             count(distinct o.tagged_account) as other_brand_count
      from edges a join chosen c on c.insta_id = a.insta_id
      left join edges o on o.insta_id = a.insta_id and o.tagged_account not in ({_BRANDS})
      where a.tagged_account in ({_BRANDS}) group by a.insta_id)
""",
    ),
    "brand_taggers": (
        ("edges", "own"),
        f"""
select o.insta_id, o.display_name, cast(sum(e.tagged_post_count) as bigint) as tag_count,
       max(e.last_tagged_date) as latest_tag_date
from own o join edges e using (insta_id) where e.tagged_account = '{fx.OTHER_BRAND}'
group by all order by tag_count desc, insta_id limit 50
""",
    ),
    "brand_months": (
        ("stage", "chosen"),
        f"""
select cast(date_trunc('month', post_date) as date) as month,
       count(distinct insta_id) as tagger_count
from stage semi join chosen using (insta_id)
where tagged_account = '{fx.OTHER_BRAND}' group by 1
""",
    ),
    "account_brands": (
        ("edges",),
        f"""
select tagged_account, tagged_post_count from edges
where insta_id = '{fx.ACCOUNT}' and tagged_account not in ({_BRANDS})
order by tagged_post_count desc, tagged_account limit 10
""",
    ),
    "account_posts": (
        ("posts",),
        f"""
select post_id, post_date, coalesce(nullif(tagged_insta_id, ''), '-') as tagged_accounts,
       coalesce(full_link, '') as full_link
from (select * from posts where insta_id = '{fx.ACCOUNT}' qualify row_number()
      over (partition by post_id order by post_date desc, last_seen_at desc) = 1)
order by post_date desc, post_id limit 10
""",
    ),
    "account_profile": (
        ("edges",),
        f"""
select insta_id, coalesce(max(nullif(insta_name, 'unknown')), '{fx.ACCOUNT}') as display_name
from edges where insta_id = '{fx.ACCOUNT}' group by insta_id
""",
    ),
    "records": (
        ("fetched",),
        rf"""
select brand_id, brand_name, grid_pos, not page_ok or (day is null and written <> '') as page_failed,
       case when page_ok then day end as post_date, post_id, insta_id,
       case when name = '' or (insta_id <> 'unknown' and lower(name) = insta_id) then 'unknown'
            else name end as insta_name,
       full_link, img_src, array_to_string(tags, ',') as tagged_insta_id,
       cast(len(tags) as int) as tagged_insta_id_cnt
from (
  select *,
    case when regexp_matches(link_path, '/p/[^/?#]+')
         then regexp_extract(link_path, '/p/([^/?#]+)', 1) else 'unknown' end as post_id,
    lower(case when len(path) >= 3 and path[2] = 'p' then path[1]
               when owner <> '' then owner else 'unknown' end) as insta_id,
    trim(trim(trim(regexp_extract(trim(meta_title), '(?i)^(.*?)\s+on Instagram:', 1)), '"')) as name,
    'https://www.instagram.com' || href as full_link,
    coalesce(nullif(og_image, ''), list_filter(captions, lambda i: i.src <> '')[1].src, '') as img_src,
    coalesce(
      cast(coalesce(try_strptime(time_iso, '%Y%m%dT%H%M%SZ'), try_strptime(time_iso, '%Y-%m-%d %H:%M'),
           try_strptime(time_iso, '%Y-%m-%dT%H:%M:%SZ'), try_strptime(time_iso, '%Y-%m-%dT%H:%M:%S+00:00'))
           + interval 9 hour as date),
      cast(try_strptime(nullif(written, ''), '%B %d, %Y') as date)) as day,
    list_filter(mentioned, lambda m, n: list_position(mentioned, m) = n) as tags
  from (
    select *, list_filter(string_split(href, '/'), lambda s: s <> '') as path,
      'https://www.instagram.com' || href as link_path,
      regexp_extract(meta_desc, '(?i)^\s*([a-z0-9._]+)\s+on\s+[a-z]+\s+\d{{1,2}},\s+\d{{4}}', 1) as owner,
      regexp_extract(meta_desc, '([A-Z][a-z]+ \d{{1,2}}, \d{{4}})', 1) as written,
      list_transform(flatten(list_transform(captions, lambda i:
        regexp_extract_all(i.alt, '@[\p{{L}}\p{{N}}_.]+'))), lambda m: rtrim(m, '.,!?:;')) as mentioned
    from (select *, list_filter([{{'alt': alt1, 'src': src1}}, {{'alt': alt2, 'src': src2}}],
                 lambda i: i.alt like 'Photo by %' or i.alt like 'Photo shared by %') as captions
          from fetched)))
""",
    ),
    "ends": (
        ("records",),
        f"""
select brand_id, min(grid_pos) as end_pos
from (select *, row_number() over (partition by brand_id, island, older order by grid_pos) as nth
      from (select *, sum(case when older then 0 else 1 end)
                        over (partition by brand_id order by grid_pos) as island
            from (select brand_id, grid_pos, post_date < {_DAY} as older
                  from records where post_date is not null)))
where older and nth = {extract.STREAK} group by brand_id
""",
    ),
    "before_end": (
        ("records", "ends"),
        """
select r.* from records r left join ends e using (brand_id)
where e.end_pos is null or r.grid_pos < e.end_pos
""",
    ),
    "business": (
        ("profiles",),
        "select distinct insta_id from profiles where "
        + " or ".join(f"contains(lower(body_text), '{k}')" for k in extract.BUSINESS_KEYWORDS),
    ),
    "judged": (
        ("before_end", "business"),
        f"""
select b.*, case
  when page_failed then 'detail_failed'
  when post_date is null then 'date_failed'
  when post_date <> {_DAY} then 'off_day'
  when insta_id = lower(brand_id)
    or insta_id in ({', '.join(f"'{a}'" for a in extract.PLATFORM_ACCOUNTS)})
    or insta_id in (select insta_id from business) then 'filtered'
  else 'collected' end as outcome
from before_end b
""",
    ),
}

# The same for the run of the day before.
for _name in ("ends", "before_end", "judged"):
    _needs, _sql = _PARTS[_name]
    for _part in ("ends", "before_end"):
        _sql = re.sub(rf"\b{_part}\b", f"{_part}_before", _sql)
    _needs = tuple(f"{n}_before" if n in ("ends", "before_end") else n for n in _needs)
    _PARTS[f"{_name}_before"] = (_needs, _sql.replace(fx.TARGET_DAY, fx.DAY_BEFORE))


def _with_parts(names: tuple[str, ...]) -> str:
    needed: set[str] = set()

    def add(name: str) -> None:
        for other in _PARTS[name][0]:
            add(other)
        needed.add(name)

    for name in names:
        add(name)
    return ",\n".join(f"{n} as ({sql})" for n, (_, sql) in _PARTS.items() if n in needed)


def statement(parts: tuple[str, ...], sql: str, text_columns: tuple[str, ...] = ()) -> str:
    """One self-contained statement; ``text_columns`` (days, times) come out as text."""
    ctes = _with_parts(parts)
    body = sql
    if text_columns:
        casts = ", ".join(f"cast({c} as varchar) as {c}" for c in text_columns)
        body = f"select * replace ({casts}) from ({sql})"
    return f"with {ctes}\n{body}" if ctes else body
