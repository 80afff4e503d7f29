"""Every operator as a named query over the given tables, with its DuckDB statement."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cotag.functions import labels, ranking
from cotag.functions.text import clean_account
from cotag.operators import co_brands, extract, freshness, ingest, marts, quality, stage, taggers
from cotag.operators import audience
from cotag.operators.audience import Audience, selected_accounts
from cotag.plans.load import load_batch
from cotag.plans.rebuild import Marts, expectations, stage_view
from cotag.schemas import BATCH
from cotag.session import shared_dir
from cotag.sources import tables
from cotag.sources.snapshots import PostTable
from cotag.streaming.drops import upsert_drops
from cotag.verify import fixtures as fx
from cotag.verify.fixtures import Fixture
from cotag.verify.oracle import statement

_POST_TIMES = ("post_date", "first_seen_at", "last_seen_at")
_EDGE_DAYS = ("first_tagged_date", "last_tagged_date")


@dataclass(frozen=True)
class Query:
    """A query on the fixture and the statement it must equal, if SQL can say it."""

    run: Callable[[Fixture], DataFrame]
    sql: str | None = None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return _days_as_text(self.run(Fixture.of(spark, sf_dir)))


def _utc_text(instant: Column) -> Column:
    """An instant as UTC wall-clock text, whatever the session zone is."""
    wall_clock = instant.cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), wall_clock).cast("string")


def _days_as_text(df: DataFrame) -> DataFrame:
    """Days and times as text, so that any client prints both engines' results alike."""
    shown = {
        "date": lambda c: c.cast("string"),
        "timestamp": _utc_text,
        "timestamp_ntz": lambda c: c.cast("string"),
    }
    return df.select(
        *(
            shown.get(f.dataType.typeName(), lambda c: c)(F.col(f.name)).alias(f.name)
            for f in df.schema
        )
    )


def _instant(text: str) -> Column:
    return F.lit(f"{text}Z").cast("timestamp")


def _audience(f: Fixture) -> Audience:
    return Audience(f.edges(), fx.BRANDS)


def _scratch(f: Fixture, name: str) -> str:
    return f"{shared_dir(f.spark)}/cotag/{f.spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:8]}"


QUERIES: dict[str, Query] = {}


def _add(
    name: str,
    run: Callable[[Fixture], DataFrame],
    sql: str | None = None,
    parts: tuple[str, ...] = (),
    text: tuple[str, ...] = (),
) -> None:
    QUERIES[name] = Query(run, None if sql is None else statement(parts, sql, text))


# ---- sources and sinks -------------------------------------------------------------------

_add("scan_posts", lambda f: f.posts(), "select * from posts", ("posts",), _POST_TIMES)


def _written(f: Fixture) -> str:
    """The batch as CSV, in one folder per brand and day."""
    folder = _scratch(f, "drops")
    tables.write_post_csv(f.batch(), folder, F.col("brand_id"), F.col("post_date"))
    return folder


_add(
    "read_post_csv",
    lambda f: tables.read_post_csv(f.spark, f"{_written(f)}/*/*").select(*f.batch().columns),
    "select * replace (nullif(full_link, '') as full_link, nullif(img_src, '') as img_src) from batch",
    ("batch",),
)
_add(
    "write_post_csv",
    lambda f: f.spark.read.schema(
        StructType([*BATCH, StructField("brand_key", StringType()), StructField("dt", StringType())])
    ).options(**tables.CSV_OPTIONS | {"enforceSchema": True}).csv(_written(f)),
    """select * replace (nullif(full_link, '') as full_link, nullif(img_src, '') as img_src),
              brand_id as brand_key, post_date as dt from batch""",
    ("batch",),
)
_add(
    "brand_dim",
    lambda f: tables.brand_dim(f.brand_records()),
    """select pos, brand_key, instagram_id, dag_id, schedule, coalesce(enabled, true) as enabled,
              coalesce(schema, 'RAW_DATA') as schema,
              coalesce(table_name, 'INSTAGRAM_POSTS') as "table"
       from brand_records qualify row_number() over (partition by brand_key order by pos desc) = 1""",
    ("brand_records",),
)
_add(
    "brand_routing",
    lambda f: tables.routed(
        f.batch().select("post_id", F.initcap("brand_id").alias("brand_key")).unionByName(
            f.table("part").select(
                F.concat(F.lit("x"), "p_partkey").alias("post_id"), F.col("p_brand").alias("brand_key")
            )
        ),
        tables.brand_dim(f.brand_records()),
    ),
    """select post_id, key as brand_key, coalesce(schema, 'RAW_DATA') as schema,
              coalesce(table_name, 'INSTAGRAM_POSTS') as "table"
       from (select post_id, 'B' || substr(brand_id, 2) as key from batch
             union all select 'x' || p_partkey, p_brand from part)
       left join (select brand_key, schema, table_name from brand_records
                  qualify row_number() over (partition by brand_key order by pos desc) = 1)
         on key = brand_key""",
    ("brand_records", "batch"),
)
_add(
    "enabled_brands",
    lambda f: tables.enabled_brands(f.brand_records()),
    "select pos, instagram_id from brand_records where coalesce(enabled, false)",
    ("brand_records",),
)
_add(
    "enabled_brands_ingest",
    lambda f: tables.enabled_brands(f.brand_records(), when_missing=True),
    "select pos, instagram_id from brand_records where coalesce(enabled, true)",
    ("brand_records",),
)


def _stage_view(f: Fixture) -> DataFrame:
    stage_view(f.posts(), "cotag_stage")
    return f.spark.sql("SELECT * FROM cotag_stage")


_add("materialize_stage", _stage_view, "select * from stage", ("stage",), ("post_date",))


_MARTS = {
    "account_tagged_accounts": ("insta_id insta_name tagged_account first_tagged_date last_tagged_date "
                                "tagged_post_count", "edges"),
    "cross_brand_accounts": ("insta_id insta_name tagged_account_count brands_tagged", "cross_brand"),
    "mart_brand_monthly_tagging": ("tagged_account month unique_tagger_count post_count", "monthly"),
    "mart_co_brand_stats": ("tagged_account tagger_count total_tag_count tagger_ratio", "stats"),
    "tagger_months": ("tagged_account month insta_id post_count", "tagger_months"),
    "edges_by_account": ("insta_id insta_name tagged_account first_tagged_date last_tagged_date "
                         "tagged_post_count", "edges"),
    "recent_posts": ("insta_id post_id post_date tagged_insta_id full_link", "recent"),
}


def _rebuilt(f: Fixture) -> DataFrame:
    """Every stored column of every mart as text, read back."""
    store = Marts(f.spark, _scratch(f, "marts"))
    store.rebuild(f.posts(), check=False)
    stored = [
        store.read(name).select(
            F.lit(name).alias("mart"),
            F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns.split()))
            .alias("mart_row"),
        )
        for name, (columns, _) in _MARTS.items()
    ]
    return reduce(DataFrame.unionByName, stored)


_add(
    "materialize_mart",
    _rebuilt,
    " union all ".join(
        f"select '{name}' as mart, concat_ws('|', "
        + ", ".join(f"coalesce(cast({c} as varchar), '-')" for c in columns.split())
        + f") as mart_row from {part}"
        for name, (columns, part) in _MARTS.items()
    ),
    tuple({part: None for _, part in _MARTS.values()}),
)
_add(
    "run_sql",
    lambda f: tables.run_sql(
        f.spark,
        "SELECT insta_id, tagged_post_count AS posts FROM {edges} WHERE tagged_account = :brand",
        {"brand": fx.OTHER_BRAND},
        edges=f.edges(),
    ),
    f"""select insta_id as "INSTA_ID", tagged_post_count as "POSTS" from edges
        where tagged_account = '{fx.OTHER_BRAND}'""",
    ("edges",),
)

# ---- extraction --------------------------------------------------------------------------

def _links(table: str, mark: str, more: str = "") -> str:
    """Pages cut at their anchors, each piece read up to the end of its tag."""
    return rf"""
select page_id, array_to_string(kept_once, ' ') as links{more}
from (select page_id, list_filter(kept, lambda h, n: list_position(kept, h) = n) as kept_once
  from (select page_id, list_filter(list_transform(list_filter(list_transform(
          string_split(regexp_replace(shown, '(?i)<a(\s)', chr(1) || '\1', 'g'), chr(1))[2:],
          lambda x: regexp_extract(split_part(x, '>', 1),
            '(?i)\shref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"'']+))', ['d', 's', 'n'])),
          lambda m: contains(m.d || m.s || m.n, '{mark}')),
          lambda m: split_part(replace(m.d || m.s || m.n, '&amp;', '&'), '?', 1)),
          lambda h: not contains(h, '/c/')) as kept
    from (select page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
                 '(?is)<script.*?</script>', '', 'g') as shown from {table})))
"""


_add(
    "x_page_links",
    lambda f: f.grids().select(
        "page_id",
        F.concat_ws(" ", extract.page_links(F.col("html"))).alias("links"),
        F.size(extract.page_links(F.col("html"))).alias("link_count"),
    ),
    _links("grids", "/p/", ", cast(len(kept_once) as int) as link_count"),
    ("grids",),
)
_add(
    "x_page_links_all",
    lambda f: f.table("pages").select(
        "page_id",
        F.concat_ws(" ", extract.page_links(F.col("html"), contains="/")).alias("links"),
    ),
    _links("pages", "/"),
)
_add(
    "x_grid_positions",
    lambda f: extract.grid_positions(f.snapshots()),
    """select brand_id, row_number() over (partition by brand_id order by first_at) as grid_pos, href
       from (select brand_id, href, min([scroll, n]) as first_at
             from (select brand_id, scroll, unnest(string_split(links, ' ')) as href,
                          generate_subscripts(string_split(links, ' '), 1) as n
                   from (select s.brand_id, s.scroll, l.links from snapshots s join ("""
    + _links("(select html as page_id, html from snapshots group by html)", "/p/")
    + """) l on l.page_id = s.html where l.links <> '')) group by all)""",
    ("snapshots",),
)
_add(
    "x_page_fields",
    lambda f: extract.page_fields(f.details()).select(
        "page_id", "meta_title", "meta_desc", "og_image", "time_iso",
        F.to_json(F.col("images")).alias("images"),
    ),
    """select page_id, case when page_id % 4 = 0 then '' else concat('N', page_id, ' & co on Instagram: x') end
                as meta_title,
              case when page_id % 3 = 1 then concat('d', page_id, ' on May 1, 2024')
                   else concat('plain ', page_id) end as meta_desc,
              case when page_id % 5 = 0 then '' else 'http://i/o.jpg' end as og_image,
              case when page_id % 6 <> 0 then concat('2024-03-0', page_id % 9 + 1, 'T10:00:00Z') end as time_iso,
              concat('[{"alt":"Photo by A with @b', page_id % 7, '","src":"1.jpg"},{"alt":"x","src":""}]') as images
       from pages""",
)
_add(
    "x_collect_runs",
    lambda f: extract.collect_runs(f.fetched_in_runs(), f.runs(), f.profiles()),
    """select run_id, post_id, insta_id, insta_name, brand_name, brand_id, full_link, img_src,
              cast(post_date as varchar) as post_date, tagged_insta_id, tagged_insta_id_cnt
       from (select 0 as run_id, * from judged union all select 1, * from judged_before)
       where outcome = 'collected'""",
    ("judged", "judged_before"),
)
_add(
    "x_caption_images",
    lambda f: f.fetched().select(
        "brand_id", "grid_pos", F.size(extract.caption_images(F.col("images"))).alias("captions")
    ),
    """select brand_id, grid_pos,
              cast((alt1 like 'Photo by %' or alt1 like 'Photo shared by %')::int
                 + (alt2 like 'Photo by %' or alt2 like 'Photo shared by %')::int as int) as captions
       from fetched""",
    ("fetched",),
)


def _page_records(f: Fixture) -> DataFrame:
    return extract.page_records(extract.dated_pages(f.fetched()))


def _records(*columns: str) -> Callable[[Fixture], DataFrame]:
    return lambda f: _page_records(f).select("brand_id", "grid_pos", *columns)


def _add_record(name: str, *columns: str) -> None:
    days = tuple(c for c in columns if c == "post_date")
    picked = ", ".join(("brand_id", "grid_pos", *columns))
    _add(name, _records(*columns), f"select {picked} from records", ("records",), days)


_add_record("x_mentions", "tagged_insta_id", "tagged_insta_id_cnt")
_add_record("x_post_id", "post_id", "full_link")
_add_record("x_owner_id", "insta_id")
_add_record("x_display_name", "insta_name")
_add_record("x_post_date", "post_date", "page_failed")
_add_record("x_image_src", "img_src")
_add(
    "x_self_tag",
    lambda f: extract.drop_self_tags(f.posts()).select("post_id", "insta_id", "brand_id"),
    "select post_id, insta_id, brand_id from posts where lower(insta_id) <> lower(brand_id)",
    ("posts",),
)
_add(
    "x_platform",
    lambda f: extract.drop_platforms(_page_records(f)).select(
        "brand_id", "grid_pos", "insta_id"
    ),
    f"""select brand_id, grid_pos, insta_id from records
        where insta_id not in ({', '.join(f"'{a}'" for a in extract.PLATFORM_ACCOUNTS)})""",
    ("records",),
)
_add(
    "x_business",
    lambda f: extract.drop_business(f.posts(), f.profiles()).select("post_id", "insta_id"),
    "select post_id, insta_id from posts anti join business using (insta_id)",
    ("posts", "business"),
)
_add(
    "x_target_day",
    lambda f: extract.on_day(_page_records(f), fx.TARGET_DAY).select(
        "brand_id", "grid_pos", "post_id"
    ),
    f"select brand_id, grid_pos, post_id from records where post_date = DATE '{fx.TARGET_DAY}'",
    ("records",),
)
_add(
    "x_streak_cutoff",
    lambda f: extract.visited_pages(f.fetched(), fx.TARGET_DAY).select(
        "brand_id", "grid_pos", "post_date"
    ),
    "select brand_id, grid_pos, post_date from before_end",
    ("before_end",),
    ("post_date",),
)
_add(
    "x_outcomes",
    lambda f: extract.outcome_counts(
        extract.judged_pages(f.fetched(), f.profiles(), fx.TARGET_DAY)
    ),
    """select brand_id, outcome, count(*) as pages from judged
       where outcome <> 'off_day' group by all""",
    ("judged",),
)
_add(
    "x_collect_posts",
    lambda f: extract.collect_posts(f.fetched(), f.profiles(), fx.TARGET_DAY),
    """select post_id, insta_id, insta_name, brand_name, brand_id, full_link, img_src,
              cast(post_date as varchar) as post_date, tagged_insta_id, tagged_insta_id_cnt
       from judged where outcome = 'collected'""",
    ("judged",),
)
_add(
    "x_batch_day",
    lambda f: f.table("events").select(
        "event_id",
        extract.batch_day(labels.utc_instant(F.col("ts"))).alias("batch_day"),
        extract.file_day(labels.utc_instant(F.col("ts"))).alias("file_day"),
    ),
    """select event_id, strftime(ts + interval 9 hour, '%Y-%m-%d') as batch_day,
              strftime(ts, '%Y%m%d') as file_day from events""",
)
_add(
    "x_day_shift",
    lambda f: f.posts().select(
        "post_id",
        extract.next_day(F.col("post_date")).alias("next_day"),
        extract.last_day(F.col("post_date")).alias("last_day"),
    ),
    "select post_id, post_date + 1 as next_day, post_date - 1 as last_day from posts",
    ("posts",),
    ("next_day", "last_day"),
)

# ---- validation and upsert ---------------------------------------------------------------


def _checks(f: Fixture) -> DataFrame:
    found = ingest.check_batch(f.bad_batch())
    return f.bad_batch().agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(found.duplicate_keys).cast("bigint").alias("duplicate_keys"),
        F.lit(found.blank_keys).cast("bigint").alias("blank_keys"),
    )


_add(
    "v_nonempty",
    _checks,
    """select cast(sum(n) as bigint) as rows, count(*) filter (where n > 1) as duplicate_keys,
              cast(sum(n) filter (where post_id is null or trim(post_id) = '') as bigint) as blank_keys
       from (select post_id, count(*) as n from bad_batch group by post_id)""",
    ("bad_batch",),
)
_add(
    "v_dup_keys",
    lambda f: ingest.duplicate_post_ids(f.bad_batch()),
    "select post_id, count(*) as cnt from bad_batch group by post_id having count(*) > 1",
    ("bad_batch",),
)
_add(
    "v_blank_keys",
    lambda f: ingest.blank_post_ids(f.bad_batch()),
    "select count(*) as blank_count from bad_batch where post_id is null or trim(post_id) = ''",
    ("bad_batch",),
)
_UPSERTED = f"""
select coalesce(p.post_id, b.post_id) as post_id,
       case when b.post_id is null then p.insta_id else b.insta_id end as insta_id,
       case when b.post_id is null then p.insta_name else b.insta_name end as insta_name,
       case when p.post_id is null then b.brand_name else p.brand_name end as brand_name,
       case when p.post_id is null then b.brand_id else p.brand_id end as brand_id,
       case when p.post_id is null then b.full_link else p.full_link end as full_link,
       case when p.post_id is null then b.img_src else p.img_src end as img_src,
       case when p.post_id is null then cast(b.post_date as date) else p.post_date end as post_date,
       case when p.post_id is null then timestamp '{fx.LOADED_AT}' else p.first_seen_at end as first_seen_at,
       case when b.post_id is null then p.last_seen_at else timestamp '{fx.LOADED_AT}' end as last_seen_at,
       case when b.post_id is null then p.active else true end as active,
       case when b.post_id is null then p.tagged_insta_id else b.tagged_insta_id end as tagged_insta_id,
       case when b.post_id is null then p.tagged_insta_id_cnt else b.tagged_insta_id_cnt end
         as tagged_insta_id_cnt
from posts p full join batch b on b.post_id = p.post_id
"""
_add(
    "upsert_posts",
    lambda f: ingest.upsert_posts(f.posts(), f.batch(), _instant(fx.LOADED_AT)),
    _UPSERTED,
    ("posts", "batch"),
    _POST_TIMES,
)
_add(
    "upsert_posts_shuffled",
    lambda f: ingest.upsert_posts(
        f.posts(), f.batch(), _instant(fx.LOADED_AT), broadcast_rows=0
    ),
    _UPSERTED,
    ("posts", "batch"),
    _POST_TIMES,
)
_add(
    "cast_post_date",
    lambda f: ingest.cast_post_date(f.batch()).select("post_id", "post_date"),
    "select post_id, cast(post_date as date) as post_date from batch",
    ("batch",),
    ("post_date",),
)


def _first_version(f: Fixture) -> PostTable:
    table = PostTable(f.spark, _scratch(f, "raw"))
    table.write(f.posts(), table.snapshot(), [])
    return table


def _swapped(f: Fixture) -> DataFrame:
    table = _first_version(f)
    load_batch(table, f.batch(), _instant(fx.LOADED_AT))
    return table.read()


_add("atomic_swap", _swapped, _UPSERTED, ("posts", "batch"), _POST_TIMES)


def _streamed(f: Fixture) -> DataFrame:
    table = _first_version(f)
    drops = _scratch(f, "drops")
    tables.write_post_csv(f.batch(), drops, F.col("brand_id"), F.lit("2024-04-01"))
    query = upsert_drops(
        f.spark,
        drops,
        table.root,
        _scratch(f, "stream"),
        now=lambda _: datetime.fromisoformat(fx.LOADED_AT).replace(tzinfo=timezone.utc),
    )
    query.awaitTermination()
    return table.read()


_FROM_CSV = "(select * replace (nullif(full_link, '') as full_link, nullif(img_src, '') as img_src) from batch)"
_add(
    "upsert_stream",
    _streamed,
    _UPSERTED.replace("join batch b", f"join {_FROM_CSV} b"),
    ("posts", "batch"),
    _POST_TIMES,
)

# ---- stage -------------------------------------------------------------------------------

_add(
    "st_filter_tagged",
    lambda f: stage.tagged_posts(f.posts()).select("post_id", "tagged_insta_id"),
    "select post_id, tagged_insta_id from posts where trim(tagged_insta_id) <> ''",
    ("posts",),
)
_add(
    "st_split",
    lambda f: stage.tagged_posts(f.posts()).select(
        "post_id",
        F.size(stage.tag_parts(F.col("tagged_insta_id"))).cast("bigint").alias("parts"),
        F.element_at(stage.tag_parts(F.col("tagged_insta_id")), -1).alias("last_part"),
    ),
    """select post_id, len(string_split(tagged_insta_id, ',')) as parts,
              string_split(tagged_insta_id, ',')[-1] as last_part
       from posts where trim(tagged_insta_id) <> ''""",
    ("posts",),
)
_add(
    "st_explode",
    lambda f: stage.explode_tags(stage.tagged_posts(f.posts())).select(
        "post_id", "tag_pos", "tagged_account_raw"
    ),
    "select post_id, tag_pos, part as tagged_account_raw from parts",
    ("parts",),
)
_add(
    "st_clean_account",
    lambda f: stage.explode_tags(stage.tagged_posts(f.posts())).select(
        "post_id", "tag_pos", clean_account(F.col("tagged_account_raw")).alias("tagged_account")
    ),
    """select post_id, tag_pos, lower(rtrim(regexp_replace(part, '^@', ''), '.')) as tagged_account
       from parts""",
    ("parts",),
)
_add(
    "st_drop_blank",
    lambda f: stage.drop_blank_parts(stage.explode_tags(stage.tagged_posts(f.posts()))).select(
        "post_id", "tag_pos", "tagged_account_raw"
    ),
    "select post_id, tag_pos, part as tagged_account_raw from parts where part <> ''",
    ("parts",),
)
_add(
    "st_surrogate_key",
    lambda f: f.stage().select("pk_tagged_post", "post_id", "tag_pos"),
    "select pk_tagged_post, post_id, tag_pos from stage",
    ("stage",),
)
_add(
    "stage_tagged_post",
    lambda f: f.stage(),
    "select * from stage",
    ("stage",),
    ("post_date",),
)

# ---- marts -------------------------------------------------------------------------------

_add(
    "best_name",
    lambda f: f.posts().groupBy("insta_id").agg(
        marts.best_name(F.col("insta_name")).alias("insta_name")
    ),
    """select insta_id, coalesce(max(nullif(insta_name, 'unknown')), 'unknown') as insta_name
       from posts group by insta_id""",
    ("posts",),
)
_add(
    "mart_account_tagged",
    lambda f: marts.account_tagged(f.posts()),
    "select * from edges",
    ("edges",),
    _EDGE_DAYS,
)
_add(
    "mart_account_tagged_from_stage",
    lambda f: marts.account_tagged_from_stage(f.stage()),
    "select * from edges",
    ("edges",),
    _EDGE_DAYS,
)
_add(
    "mart_cross_brand",
    lambda f: marts.cross_brand_accounts(f.edges()),
    "select * from cross_brand",
    ("cross_brand",),
)
_add(
    "mart_brand_monthly",
    lambda f: marts.brand_monthly_tagging(f.posts()),
    "select * from monthly",
    ("monthly",),
    ("month",),
)
_add(
    "mart_brand_monthly_from_stage",
    lambda f: marts.brand_monthly_from_stage(f.stage()),
    "select * from monthly",
    ("monthly",),
    ("month",),
)
_add(
    "mart_co_brand_stats",
    lambda f: marts.co_brand_stats(f.edges()),
    "select * from stats",
    ("stats",),
)

# ---- serving -----------------------------------------------------------------------------

_add(
    "selected_accounts",
    lambda f: selected_accounts(f.edges(), fx.BRANDS),
    "select insta_id from chosen",
    ("chosen",),
)
_add(
    "selected_by_bitmaps",
    lambda f: audience.selected_by_bitmaps(f.bitmaps(), f.account_numbers(), fx.BRANDS),
    "select insta_id from chosen",
    ("chosen",),
)
_add(
    "selected_size",
    lambda f: audience.selected_size(f.bitmaps(), fx.BRANDS),
    "select count(*) as total from chosen",
    ("chosen",),
)
_KPI = """
select count(*) as total_accounts, round(coalesce(avg(tag_count), 0), 1) as avg_tag_count,
       first(insta_id order by tag_count desc, insta_id) as top_tagger_id,
       first(display_name order by tag_count desc, insta_id) as top_tagger_name,
       first(tag_count order by tag_count desc, insta_id) as top_tagger_count
from own
"""
_add("tagger_kpi", lambda f: taggers.tagger_kpi(_audience(f)), _KPI, ("own",))
_add(
    "top_tagger",
    lambda f: taggers.top_tagger(_audience(f)),
    """select insta_id, display_name, tag_count from own
       order by tag_count desc, insta_id limit 1""",
    ("own",),
)
_add(
    "tagger_list",
    lambda f: taggers.tagger_list(_audience(f), 20, 20, f.cross_brand()),
    "select * from listed where rank between 21 and 40",
    ("listed",),
    ("latest_tag_date",),
)


def _second_page(f: Fixture) -> DataFrame:
    chosen, cross_brand = _audience(f), f.cross_brand()
    first = taggers.tagger_list(chosen, 20, 0, cross_brand).orderBy(F.desc("rank")).first()
    return taggers.tagger_list_after(chosen, first.asDict(), 20, cross_brand)


_add(
    "tagger_list_after",
    _second_page,
    "select * from listed where rank between 21 and 40",
    ("listed",),
    ("latest_tag_date",),
)
_add(
    "tagger_list_exact",
    lambda f: taggers.tagger_list_exact(_audience(f), 20, 20, f.cross_brand()),
    f"""select rank, insta_id, display_name as insta_name, tag_count, latest_tag_date,
               (select count(*) from edges e where e.insta_id = r.insta_id
                  and e.tagged_account not in ('brand#1', 'brand#2')) as other_brand_count
        from (select *, row_number() over
                (order by tag_count desc, latest_tag_date desc, insta_id) as rank from own) r
        where rank between 21 and 40""",
    ("edges", "own"),
    ("latest_tag_date",),
)
_add(
    "tagger_count",
    lambda f: taggers.tagger_count(_audience(f)),
    "select count(*) as total from chosen",
    ("chosen",),
)
_add(
    "page_info",
    lambda f: taggers.tagger_count(_audience(f)).select(
        "total",
        F.lit(ranking.page_offset(3, 20)).cast("bigint").alias("third_page_offset"),
        ranking.page_count(F.col("total"), 20).alias("pages"),
    ),
    """select count(*) as total, cast(40 as bigint) as third_page_offset,
              cast(ceil(count(*) / 20) as bigint) as pages from chosen""",
    ("chosen",),
)
_add(
    "tagger_top_brands",
    lambda f: taggers.tagger_top_brands(f.edges_by_account(), fx.ACCOUNT, fx.BRANDS),
    "select * from account_brands",
    ("account_brands",),
)
_add(
    "tagger_recent_posts",
    lambda f: taggers.tagger_recent_posts(f.recent_posts(), fx.ACCOUNT, keyed=True),
    "select * from account_posts",
    ("account_posts",),
    ("post_date",),
)
_add(
    "tagger_profile",
    lambda f: taggers.tagger_profile(f.edges_by_account(), fx.ACCOUNT),
    "select * from account_profile",
    ("account_profile",),
)
_add(
    "tagger_detail",
    lambda f: taggers.tagger_detail(
        f.edges_by_account(), f.recent_posts(), fx.ACCOUNT, fx.BRANDS, keyed=True
    ),
    """select 'profile' as section,
              cast(to_json({'insta_id': insta_id, 'display_name': display_name}) as varchar) as data
       from account_profile
       union all
       select 'top_brands', coalesce(cast(to_json(list({'brand': tagged_account,
              'count': tagged_post_count} order by tagged_post_count desc, tagged_account))
              as varchar), '[]') from account_brands
       union all
       select 'recent_posts', coalesce(cast(to_json(list({'post_id': post_id,
              'post_date': cast(post_date as varchar), 'tagged_accounts': tagged_accounts,
              'full_link': full_link} order by post_date desc, post_id)) as varchar), '[]')
       from account_posts""",
    ("account_brands", "account_posts", "account_profile"),
)
_add(
    "co_brand_kpi",
    lambda f: co_brands.co_brand_kpi(_audience(f)),
    """select (select count(*) from chosen) as total_accounts,
              count(distinct tagged_account) as co_brand_count
       from edges semi join chosen using (insta_id)
       where tagged_account not in ('brand#1', 'brand#2')""",
    ("edges", "chosen"),
)
_add(
    "co_brand_ranking",
    lambda f: co_brands.co_brand_ranking(_audience(f)),
    "select * from ranking",
    ("ranking",),
)
_add(
    "co_brand_top10",
    lambda f: co_brands.co_brand_top(_audience(f)),
    "select * from ranking where rank <= 10",
    ("ranking",),
)
_add(
    "co_brand_taggers",
    lambda f: co_brands.co_brand_taggers(_audience(f), fx.OTHER_BRAND),
    "select * from brand_taggers",
    ("brand_taggers",),
    ("latest_tag_date",),
)
_add(
    "co_brand_monthly",
    lambda f: co_brands.co_brand_monthly(
        _audience(f), f.months(), fx.OTHER_BRAND
    ),
    "select * from brand_months",
    ("brand_months",),
    ("month",),
)
_add(
    "co_brand_detail",
    lambda f: co_brands.co_brand_detail(_audience(f), f.months(), fx.OTHER_BRAND),
    """select 'taggers' as section, coalesce(cast(to_json(list({'insta_id': insta_id,
              'display_name': display_name, 'tag_count': tag_count,
              'latest_tag_date': cast(latest_tag_date as varchar)}
              order by tag_count desc, insta_id)) as varchar), '[]') as data
       from brand_taggers
       union all
       select 'monthly', coalesce(cast(to_json(list({'month': cast(month as varchar),
              'tagger_count': tagger_count} order by month)) as varchar), '[]')
       from brand_months""",
    ("brand_taggers", "brand_months"),
)

# ---- freshness, labels, shares -----------------------------------------------------------

_add(
    "freshness_committed",
    lambda f: _first_version(f).freshness(),
    """select max(last_seen_at) as last_loaded_at, max(post_date) as latest_post_date from posts""",
    ("posts",),
    ("last_loaded_at", "latest_post_date"),
)
_add(
    "freshness",
    lambda f: freshness.freshness(f.posts()),
    """select max(last_seen_at) as last_loaded_at, max(post_date) as latest_post_date from posts""",
    ("posts",),
    ("last_loaded_at", "latest_post_date"),
)


_add(
    "freshness_tone",
    lambda f: freshness.freshness(f.posts().groupBy("insta_id"))
    .select(
        "insta_id",
        labels.freshness_tone(
            F.col("last_loaded_at"), F.col("latest_post_date"), _instant(fx.NOW)
        ).alias("tone"),
    ),
    f"""select insta_id, case
          when epoch(timestamp '{fx.NOW}' - max(last_seen_at)) / 3600 <= 12
           and epoch(timestamp '{fx.NOW}' - max(post_date)) / 86400 <= 1 then 'healthy'
          when epoch(timestamp '{fx.NOW}' - max(last_seen_at)) / 3600 <= 24
           and epoch(timestamp '{fx.NOW}' - max(post_date)) / 86400 <= 2 then 'watch'
          else 'stale' end as tone
        from posts group by insta_id""",
    ("posts",),
)
_add(
    "age_bucket",
    lambda f: f.posts().select(
        "post_id",
        labels.age_bucket(F.col("last_seen_at"), _instant(fx.NOW)).alias("age"),
    ),
    f"""select post_id, case when hours < 1 then '{labels.AGE_NOW}'
               when hours < 24 then cast(floor(hours) as bigint) || '{labels.AGE_HOURS}'
               else cast(floor(hours / 24) as bigint) || '{labels.AGE_DAYS}' end as age
        from (select post_id, epoch(timestamp '{fx.NOW}' - last_seen_at) / 3600 as hours from posts)""",
    ("posts",),
)
_add(
    "share_of_max",
    lambda f: labels.with_first_row_share(
        labels.with_bar_share(
            co_brands.co_brand_top(_audience(f)).select("rank", "tagged_account", "tagger_count"),
            "tagger_count",
            name="bar_share",
        ),
        "tagger_count",
        name="row_share",
    ),
    """select rank, tagged_account, tagger_count,
              tagger_count / greatest(max(tagger_count) over (), 1) * 100.0::double as bar_share,
              tagger_count / first(tagger_count) over (order by rank) * 100.0::double as row_share
       from ranking where rank <= 10""",
    ("ranking",),
)
_add(
    "brand_search",
    lambda f: tables.brand_search(f.brand_records(), "#1", "instagram_id").select(
        "pos", "instagram_id"
    ),
    "select pos, instagram_id from brand_records where contains(lower(instagram_id), '#1')",
    ("brand_records",),
)
_add(
    "brand_param",
    lambda f: tables.known_brands(
        f.posts().select(
            "post_id", F.explode(tables.brand_param(F.col("tagged_insta_id"))).alias("instagram_id")
        ),
        f.table("part").select(F.col("p_brand").alias("instagram_id")).distinct(),
    ).select("post_id", "instagram_id"),
    """select post_id, trim(x) as instagram_id
       from (select post_id, unnest(string_split(tagged_insta_id, ',')) as x from posts)
       where trim(x) <> '' and trim(x) in (select p_brand from part)""",
    ("posts",),
)
_add(
    "month_label",
    lambda f: marts.brand_monthly_tagging(f.posts()).select(
        "tagged_account", labels.month_label(F.col("month")).alias("label"), "post_count"
    ),
    "select tagged_account, strftime(month, '%Y-%m') as label, post_count from monthly",
    ("monthly",),
)
_add(
    "date_label",
    lambda f: f.posts().select(
        "post_id",
        labels.date_label(
            F.when(F.col("tagged_insta_id_cnt") > 0, _utc_text(F.col("last_seen_at")))
        ).alias("label"),
    ),
    """select post_id, case when tagged_insta_id_cnt > 0 then strftime(last_seen_at, '%Y-%m-%d')
                            else '-' end as label from posts""",
    ("posts",),
)
_add(
    "empty_defaults",
    lambda f: taggers.kpi_defaults(
        taggers.tagger_kpi(Audience(f.edges(), [*fx.BRANDS, "nobody"]))
    ),
    """select cast(0 as bigint) as total_accounts, cast(0 as double) as avg_tag_count,
              cast(null as varchar) as top_tagger_id, cast(null as varchar) as top_tagger_name,
              cast(0 as bigint) as top_tagger_count
       from (select count(*) as n from edges where tagged_account = 'nobody') where n = 0""",
    ("edges",),
)

# ---- data tests --------------------------------------------------------------------------


def _with_flaws(posts: DataFrame) -> DataFrame:
    """Posts with some values taken out, so that the tests have something to find."""
    return posts.withColumns(
        {
            "insta_id": F.expr("case when post_id like '%7' then null else insta_id end"),
            "post_date": F.expr("case when post_id like '%33' then null else post_date end"),
            "post_id": F.expr("case when post_id like '%55' then 'p5' else post_id end"),
            "tagged_insta_id": F.expr(
                "case when post_id like '%9' then concat(tagged_insta_id, ',@,...') "
                "else tagged_insta_id end"
            ),
        }
    )


_FLAWED = """
(select * replace (
   case when post_id like '%7' then null else insta_id end as insta_id,
   case when post_id like '%33' then null else post_date end as post_date,
   case when post_id like '%55' then 'p5' else post_id end as post_id,
   case when post_id like '%9' then tagged_insta_id || ',@,...'
        else tagged_insta_id end as tagged_insta_id) from posts)
"""

_add(
    "dq_not_null",
    lambda f: quality.null_counts(
        _with_flaws(f.posts()), ("insta_id", "brand_name", "post_id", "post_date")
    ),
    f"""select unnest(['insta_id', 'brand_name', 'post_id', 'post_date']) as column_name,
               unnest([count(*) - count(insta_id), count(*) - count(brand_name),
                       count(*) - count(post_id), count(*) - count(post_date)]) as null_count
        from {_FLAWED}""",
    ("posts",),
)
_add(
    "dq_unique",
    lambda f: quality.duplicate_keys(_with_flaws(f.posts()), ["post_id"]),
    f"""select post_id, count(*) as row_count from {_FLAWED}
        where post_id is not null group by post_id having count(*) > 1""",
    ("posts",),
)
_add(
    "dq_unique_pair",
    lambda f: quality.duplicate_pairs(f.stage()),
    """select insta_id, tagged_account, count(*) as row_count from stage
       group by all having count(*) > 1""",
    ("stage",),
)
_add(
    "dq_not_blank",
    lambda f: quality.blank_accounts(
        stage.tagged_post_rows(_with_flaws(f.posts()))
    ).select("post_id", "tag_pos", "tagged_account"),
    f"""select post_id, tag_pos, '' as tagged_account
        from (select post_id, u.part, u.tag_pos from {_FLAWED} as p
              cross join unnest(string_split(p.tagged_insta_id, ',')) with ordinality
              as u(part, tag_pos) where trim(p.tagged_insta_id) <> '')
        where trim(part) <> '' and rtrim(regexp_replace(trim(part), '^@', ''), '.') = ''""",
    ("posts",),
)
_add(
    "dq_positive",
    lambda f: quality.accounts_without_tags(
        marts.cross_brand_accounts(f.edges()).withColumn(
            "tagged_account_count", F.col("tagged_account_count") - 10
        )
    ).select("insta_id", "tagged_account_count"),
    """select insta_id, tagged_account_count - 10 as tagged_account_count from cross_brand
       where tagged_account_count - 10 < 1""",
    ("cross_brand",),
)


def _all_checks_sql() -> str:
    """One SELECT per data test, in the names of :func:`expectations`."""
    source = {
        "posts": "posts",
        "stage": "stage",
        "account_tagged_accounts": "edges",
        "cross_brand_accounts": "cross_brand",
    }
    found = [
        f"select '{name}.{c} not null' as check_name, count(*) - count({c}) as failures "
        f"from {source[name]}"
        for name, columns in quality.REQUIRED.items()
        for c in columns
    ]
    found += [
        f"select '{name} unique {c[0]}', count(*) from (select {c[0]} from {source[name]} "
        f"where {c[0]} is not null group by {c[0]} having count(*) > 1)"
        for name, c in quality.UNIQUE.items()
        if len(c) == 1
    ]
    found += [
        "select 'stage.tagged_account not blank', count(*) from stage where trim(tagged_account) = ''",
        "select 'edges unique pair', count(*) from (select insta_id, tagged_account from edges "
        "group by all having count(*) > 1)",
        "select 'cross_brand_accounts.tagged_account_count positive', count(*) from cross_brand "
        "where tagged_account_count < 1",
    ]
    return " union all ".join(found)


_add(
    "dq_all",
    lambda f: expectations(
        f.posts(),
        f.stage(),
        {
            "account_tagged_accounts": f.edges(),
            "cross_brand_accounts": marts.cross_brand_accounts(f.edges()),
        },
    ),
    _all_checks_sql(),
    ("posts", "stage", "edges", "cross_brand"),
)
