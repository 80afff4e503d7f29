"""Inputs of the engine, derived by Spark from the given tables.

The statements hold for Spark and DuckDB alike; only the two places in braces differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotag.functions.labels import utc_instant
from cotag.operators.audience import account_numbers, brand_bitmaps
from cotag.operators.marts import (
    account_tagged, cross_brand_accounts, month_runs, recent_posts, tagger_months,
)
from cotag.operators.stage import tagged_post_rows
from cotag.plans.rebuild import write_by_account, write_mart
from cotag.session import shared_dir
from cotag.sources.tables import scan_posts

SOURCE_TABLES = ("orders", "customer", "lineitem", "part", "pages", "events")

BRANDS = ["brand#1", "brand#2"]
OTHER_BRAND = "brand#7"
ACCOUNT = "user10"
TARGET_DAY = "2024-03-28"
DAY_BEFORE = "2024-03-27"
NOW = "2001-08-02 12:00:00"
LOADED_AT = "2024-04-01 00:00:00"

SPARK_DIALECT = {
    "tag_list": "listagg(tag, ',') WITHIN GROUP "
    "(ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)",
    "long_date": "date_format({day}, 'MMMM d, yyyy')",
}
DUCKDB_DIALECT = {
    "tag_list": "string_agg(tag, ',' "
    "ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)",
    "long_date": "strftime({day}, '%B %-d, %Y')",
}

#: Raw posts: one per order, tagged with the brands of its line items in messy spellings.
POSTS_SQL = """
with t as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         case when l_quantity = 1 then ''
              when l_linenumber % 4 = 0 then concat('@', p_brand)
              when l_linenumber % 4 = 1 then concat(' ', p_brand, ' ')
              when l_linenumber % 4 = 2 then concat('@', upper(p_brand), '.')
              else p_brand end as tag
  from {lineitem} join {part} on l_partkey = p_partkey),
g as (select l_orderkey, {tag_list} as tagged_insta_id, cast(count(*) as int) as cnt
      from t group by l_orderkey)
select concat('p', o_orderkey) as post_id,
       concat('user', o_custkey) as insta_id,
       case when o_orderkey % 3 = 0 then 'unknown' else c_name end as insta_name,
       c_mktsegment as brand_name,
       case when o_orderkey % 50 = 0 then concat('USER', o_custkey)
            else concat('brand#', o_orderkey % 25 + 1) end as brand_id,
       concat('https://www.instagram.com/user', o_custkey, '/p/p', o_orderkey, '/') as full_link,
       '' as img_src,
       cast(o_orderdate as date) as post_date,
       o_orderdate + interval 6 hour as first_seen_at,
       case when o_orderkey % 2 = 0 then o_orderdate + interval 6 hour
            else o_orderdate + interval 30 hour end as last_seen_at,
       true as active,
       tagged_insta_id, coalesce(cnt, 0) as tagged_insta_id_cnt
from {orders} join {customer} on o_custkey = c_custkey left join g on l_orderkey = o_orderkey
"""

#: The grouping of ``POSTS_SQL`` by aggregation: Spark's ``listagg`` writes a buffer of its own for
#: every row, before and after the shuffle.
GROUPED_TAGS = """g as (select l_orderkey, {tag_list} as tagged_insta_id, cast(count(*) as int) as cnt
      from t group by l_orderkey)"""

#: The same rows by sorting: line items are shuffled and sorted once as plain rows, and the first of
#: an order carries its list.
SORTED_TAGS = """s as (
  select l_orderkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey,
           l_suppkey, l_extendedprice, tag) as place,
         collect_list(tag) over whole as tags, count(*) over whole as cnt
  from t where l_orderkey is not null
  window whole as (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
                   l_extendedprice, tag rows between unbounded preceding and unbounded following)),
g as (select l_orderkey, case when size(tags) > 0 then array_join(tags, ',') end as tagged_insta_id,
             cast(cnt as int) as cnt
      from s where place = 1)"""

#: A batch against ``posts``, from all orders: half known posts (renamed, other brand, some tags
#: gone), half new ones; some texts have white space at their ends.
BATCH_SQL = """
select case when o_orderkey % 2 = 0 then concat('p', o_orderkey)
            when o_orderkey % 9 = 0 then concat(' n', o_orderkey, ' ')
            else concat('n', o_orderkey) end as post_id,
       concat('user', o_custkey) as insta_id,
       case when o_orderkey % 8 = 0 then concat(chr(9), 'renamed ') else 'renamed' end as insta_name,
       'other' as brand_name, concat('brand#', o_orderkey % 3 + 90) as brand_id, '' as full_link,
       '' as img_src, concat('', cast(o_orderdate as date)) as post_date,
       case when o_orderkey % 4 = 0 then null when o_orderkey % 7 = 0 then ' @Brand#1 , @brand#99 '
            else '@Brand#1,@brand#99' end as tagged_insta_id,
       cast(case when o_orderkey % 4 = 0 then 0 else 2 end as int) as tagged_insta_id_cnt
from {orders}
"""

#: A batch with repeated, NULL and blank keys.
BAD_BATCH_SQL = """
select case when o_orderkey % 17 = 0 then null
            when o_orderkey % 19 = 0 then ''
            when o_orderkey % 23 = 0 then '   '
            when o_orderkey % 5 = 0 then concat('p', o_custkey)
            else concat('p', o_orderkey, '-') end as post_id
from {orders}
"""

#: Page fields per grid position: newest first within a few days' jitter, so that streaks of
#: older posts are broken and resumed. Positions are dense within a brand.
FETCHED_SQL = """
with o as (
  select o_orderkey, o_custkey, c_name,
         cast(floor(o_orderkey / 25) as bigint) + 1 as grid_pos,
         cast(date '2024-03-31' - cast(floor(o_orderkey / 200) % 3650 as int)
              + cast(o_custkey % 5 as int) - 2 as date) as shown_day
  from {orders} join {customer} on o_custkey = c_custkey)
select concat('brand#', o_orderkey % 25 + 1) as brand_id,
       concat('label ', o_orderkey % 25 + 1) as brand_name,
       grid_pos,
       case when o_orderkey % 11 = 0 then concat('/p/p', o_orderkey, '/')
            when o_orderkey % 29 = 0 then concat('/Brand#', o_orderkey % 25 + 1, '/p/p', o_orderkey, '/')
            when o_orderkey % 37 = 0 then concat('/Kasina/p/p', o_orderkey)
            when o_orderkey % 41 = 0 then concat('/User', o_custkey, '/')
            else concat('/User', o_custkey, '/p/p', o_orderkey, '/') end as href,
       case when o_orderkey % 5 = 0 then ''
            when o_orderkey % 13 = 0 then concat(' " ', c_name, ' " on instagram: "y"')
            when o_orderkey % 17 = 0 then concat('USER', o_custkey, ' on Instagram: "z"')
            else concat(c_name, ' on Instagram: "x"') end as meta_title,
       case when o_orderkey % 91 = 0 then ''
            when o_orderkey % 21 = 0 then concat('user', o_custkey, ' on Octember 40, 2024: hi')
            else concat('user', o_custkey, ' on ', {long_date}, ': hi') end as meta_desc,
       case when o_orderkey % 4 = 0 then '' else 'http://i/og.jpg' end as og_image,
       case when o_orderkey % 7 = 0 then null
            when o_orderkey % 31 = 0 then 'soon'
            when o_orderkey % 43 = 0 then '10:00:00'
            when o_orderkey % 47 = 0 then '2024-03'
            when o_orderkey % 53 = 0 then concat(replace(cast(shown_day as varchar(10)), '-', ''), 'T233000Z')
            when o_orderkey % 59 = 0 then concat(shown_day, ' 16:00')
            when o_orderkey % 2 = 0 then concat(shown_day, 'T15:30:00Z')
            else concat(shown_day, 'T10:00:00+00:00') end as time_iso,
       case when o_orderkey % 6 = 0 then 'May be a picture of @nobody'
            else concat('Photo by ', c_name, ' with @Brand.', o_orderkey % 9, '!, @brand.',
                        o_orderkey % 3, '.') end as alt1,
       case when o_orderkey % 8 = 0 then '' else 'http://i/1.jpg' end as src1,
       case when o_orderkey % 10 < 5 then concat('Photo shared by x: @brand.', o_orderkey % 3,
                                                 ' @café_', o_orderkey % 4, '...')
            else 'Photo' end as alt2,
       'http://i/2.jpg' as src2,
       o_orderkey % 97 <> 0 as page_ok
from o
"""

#: Profile texts: one for every second account, some of a business.
PROFILES_SQL = """
select concat('user', c_custkey) as insta_id,
       case when c_custkey % 10 = 0 then 'Posts 12 View Shop Contact'
            when c_custkey % 14 = 0 then '의류(브랜드)'
            else concat('I am ', c_name) end as body_text
from {customer} where c_custkey % 2 = 0
"""

#: Brand records with repeated keys and missing values.
BRAND_RECORDS_SQL = """
select cast(p_partkey as int) as pos, p_brand as brand_key,
       concat(lower(p_brand), '.', p_size) as instagram_id,
       concat('collect_', p_partkey) as dag_id, '30 18 * * *' as schedule,
       case when p_size % 3 = 0 then null when p_size % 3 = 1 then true else false end as enabled,
       case when p_size % 4 = 0 then 'RAW_2' end as schema,
       cast(null as varchar(10)) as table_name
from {part}
"""

#: Grid pages: the given pages with their links turned into post and comment links.
GRIDS_SQL = """
select page_id,
       replace(replace(replace(replace(replace(replace(replace(html,
                 '<a href="/is"', '<A HREF=/u/p/is'),
                 '<a href="/the"', '<a Href=''/u/p/the'' '),
                 '<a href="/th', '<a href="/p/x&amp;y/th'),
                 '<!-- ad', '<!-- <a href="/u/p/hidden/">ad</a>'),
                 '<a href="/t', '<a href="/u/p/c/t'),
                 '<a href="/a', '<a class="x" href="/p/a?q=1&amp;r='),
                 '<a href="/o', '<a href="/u/p/o') as html
from {pages}
"""

#: Grid snapshots: each page's grid shown in three scrolls, the later ones with links of before.
SNAPSHOTS_SQL = """
select page_id % 40 as brand_id, cast(scroll + 3 * floor(page_id / 40) as int) as scroll,
       case scroll when 0 then left(html, cast(length(html) / 2 as int)) else html end as html
from (select 0 as scroll, page_id, html from {grids} union all
      select 1, page_id, html from {grids} union all select 2, page_id, html from {grids})
"""

#: Detail pages, made of the given pages' texts.
DETAILS_SQL = """
select page_id,
       concat('<!DOCTYPE html><html><head><META name=description content="plain ', page_id, '">',
         case when page_id % 4 = 0 then '' else
           concat('<meta property="og:title" content="N', page_id, ' &amp; co on Instagram: x">') end,
         case when page_id % 3 = 0 then '' when page_id % 3 = 1 then
           concat('<meta content=''d', page_id, ' on May 1, 2024'' property=''og:description''/>')
           else '<!-- <meta property="og:description" content="hidden"> -->' end,
         '<meta property="og:image" content="', case when page_id % 5 = 0 then '' else 'http://i/o.jpg' end,
         '"></head><body><img alt="Photo by outside" src="o"><main class="m">',
         case when page_id % 6 = 0 then '' else concat('<time datetime="2024-03-0', page_id % 9 + 1,
              'T10:00:00Z">x</time><time datetime="2020-01-01">y</time>') end,
         '<img src="1.jpg" alt="Photo by A with @b', page_id % 7, '"><img alt=''x''>',
         '</main><p>', html, '</p></body></html>') as html
from {pages}
"""


def for_duckdb(sql: str) -> str:
    """A statement of this module over plainly named tables."""
    return _filled(sql, DUCKDB_DIALECT, {name: name for name in SOURCE_TABLES})


def _filled(sql: str, dialect: dict[str, str], tables: dict[str, str]) -> str:
    for name, text in dialect.items():
        sql = sql.replace("{" + name + "}", text.replace("{day}", "shown_day"))
    for name, text in tables.items():
        sql = sql.replace("{" + name + "}", text)
    return sql


class Fixture:
    """Derived tables for one data folder and one Spark application.

    ``posts``, ``edges`` and ``fetched`` are tables in the engine, so they are written once to the
    shared folder and read back; all others are lazy.
    """

    _open: dict[tuple[str, str], Fixture] = {}

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._stored: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Fixture:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._open:
            cls._open[key] = cls(spark, sf_dir)
        return cls._open[key]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, sql: str) -> DataFrame:
        used = {name: self.table(name) for name in SOURCE_TABLES if "{" + name + "}" in sql}
        return self.spark.sql(_filled(sql, SPARK_DIALECT, {}), **used)

    def _folder(self, name: str) -> str:
        app = self.spark.sparkContext.applicationId
        data = hashlib.md5(self.sf_dir.encode()).hexdigest()[:12]
        return f"{shared_dir(self.spark)}/cotag/{app}/{data}/{name}"

    def posts(self) -> DataFrame:
        if "posts" not in self._stored:
            instants = {
                c: utc_instant(F.col(c)) for c in ("first_seen_at", "last_seen_at")
            }
            posts = self.sql(POSTS_SQL.replace(GROUPED_TAGS, SORTED_TAGS))
            write_mart(posts.withColumns(instants), self._folder("posts"))
            self._stored["posts"] = scan_posts(self.spark, self._folder("posts"))
        return self._stored["posts"]

    def edges(self) -> DataFrame:
        if "edges" not in self._stored:
            self._stored["edges"] = write_mart(
                account_tagged(self.posts()),
                self._folder("edges"),
                "tagged_account",
                "insta_id",
                lookup="insta_id",
            )
        return self._stored["edges"]

    def _once(self, name: str, build: Callable[[str], DataFrame]) -> DataFrame:
        if name not in self._stored:
            self._stored[name] = build(self._folder(name))
        return self._stored[name]

    def months(self) -> DataFrame:
        return self._once("months", lambda path: write_mart(
            tagger_months(self.posts()), path, "tagged_account", "month", "insta_id",
            order=month_runs()))

    def cross_brand(self) -> DataFrame:
        return self._once("cross_brand", lambda path: write_mart(
            cross_brand_accounts(self.edges()), path))

    def account_numbers(self) -> DataFrame:
        return self._once("account_numbers", lambda path: write_mart(
            account_numbers(self.edges()), path, "account_number"))

    def bitmaps(self) -> DataFrame:
        return self._once("bitmaps", lambda path: write_mart(
            brand_bitmaps(self.edges(), self.account_numbers()), path, "tagged_account", "bucket"))

    def edges_by_account(self) -> DataFrame:
        return self._once("edges_by_account", lambda path: write_by_account(self.edges(), path))

    def recent_posts(self) -> DataFrame:
        return self._once("recent_posts", lambda path: write_by_account(
            recent_posts(self.posts()), path))

    def stage(self, tagged_account: str | None = None) -> DataFrame:
        return tagged_post_rows(self.posts(), tagged_account)

    def batch(self) -> DataFrame:
        return self.sql(BATCH_SQL)

    def bad_batch(self) -> DataFrame:
        return self.sql(BAD_BATCH_SQL)

    def profiles(self) -> DataFrame:
        return self.sql(PROFILES_SQL)

    def brand_records(self) -> DataFrame:
        return self.sql(BRAND_RECORDS_SQL).withColumnRenamed("table_name", "table")

    def grids(self) -> DataFrame:
        return self.sql(GRIDS_SQL)

    def snapshots(self) -> DataFrame:
        return self.spark.sql(SNAPSHOTS_SQL, grids=self.grids())

    def details(self) -> DataFrame:
        return self.sql(DETAILS_SQL)

    def runs(self) -> DataFrame:
        """Two runs per brand, for the target day and the day before."""
        days = F.array(*(F.struct(F.lit(n).alias("run_id"), F.lit(day).alias("target_day"))
                         for n, day in enumerate((TARGET_DAY, DAY_BEFORE))))
        brands = self.fetched().select("brand_id").distinct()
        return brands.select("brand_id", F.explode(days).alias("_r")).select("brand_id", "_r.*")

    def fetched_in_runs(self) -> DataFrame:
        runs = F.explode(F.array(F.lit(0), F.lit(1))).alias("run_id")
        return self.fetched().select("*", runs)

    def fetched(self) -> DataFrame:
        if "fetched" not in self._stored:
            images = F.array(
                F.struct(F.col("alt1").alias("alt"), F.col("src1").alias("src")),
                F.struct(F.col("alt2").alias("alt"), F.col("src2").alias("src")),
            )
            pages = self.sql(FETCHED_SQL).withColumn("images", images)
            self._stored["fetched"] = write_mart(
                pages.drop("alt1", "src1", "alt2", "src2"),
                self._folder("fetched"),
                "brand_id",
                "grid_pos",
            )
        return self._stored["fetched"]
