"""From fetched page fields to post records.

Input ``fetched``: ``brand_id, brand_name, grid_pos, href, meta_title, meta_desc, og_image,
time_iso, images array<struct<alt, src>>, page_ok``, one row per grid position of a brand.
Input ``profiles``: ``insta_id, body_text``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotag.functions.joins import BROADCAST_ROWS, drop_matching, held, keep_matching
from cotag.functions.ranking import rank_within
from cotag.functions.text import strip
from cotag.schemas import BATCH_COLUMNS, UNKNOWN

# Text patterns of the page fields. Spaces, digits and word characters are the
# Unicode ones.
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
MENTION = r"@[\p{L}\p{N}_.]+"
POST_URL = r"/p/([^/?#]+)/?"
OWNER_IN_DESCRIPTION = (
    rf"(?i)^{_SPACE}*([A-Za-z0-9._]+){_SPACE}+on{_SPACE}+[A-Z][a-z]+{_SPACE}+"
    rf"\p{{Nd}}{{1,2}},{_SPACE}+\p{{Nd}}{{4}}"
)
NAME_IN_TITLE = rf"(?i)^([^\n]*?){_SPACE}+on Instagram:"
DATE_IN_DESCRIPTION = r"([A-Z][a-z]+ \d{1,2}, \d{4})"
# The tokens of a page, as browsers cut it: comments, elements whose content is text, tags with their
# attributes, other markup. Pages may be cut anywhere: a page that ends inside of a tag still shows the
# attributes that are whole, and a comment or text element without an end hides nothing. No
# quantifier of a group gives anything back, so long pages cost neither time nor stack.
_VALUE = r"""(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^\s>"'][^\s>]*+)"""
_NAME = r"[^\s/>][^\s/>=]*+"
_ATTRIBUTES = rf"(?:[\s/]++|{_NAME}(?:\s*+=\s*+{_VALUE}?+)?+)*+"
_TEXT_ELEMENTS = "script|style|textarea|title|iframe|noscript|noembed|noframes|xmp"
TOKEN = (
    r"(?is)<!--(?:-?>|.*?--!?>|)"
    rf"|<({_TEXT_ELEMENTS})(?=[\s/>]){_ATTRIBUTES}>.*?</\1(?=[\s/>])"
    rf"|<[a-z][^\s/>]*+{_ATTRIBUTES}(?:>|\z)"
    r"|<[!?/][^>]*+(?:>|\z)"
)


def _attribute_pattern(name: str) -> str:
    """The first attribute of this name in a tag, its value as the first group."""
    other = rf"(?!{name}\s*+=){_NAME}(?:\s*+=\s*+{_VALUE}?+)?+"
    whole = r"""("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
    return rf"(?is)^<[a-z][^\s/>]*+(?:[\s/]++|{other})*+{name}\s*+=\s*+{whole}"


# Character references that occur in link targets; the ampersand comes last.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
_ZONE = r"(Z|[+-]\d{2}(?::?\d{2})?)?"
_FRACTION = r"(?:[.,]\d+)?"
ISO_TEXT = (
    rf"^(?:(\d{{4}})-(\d{{2}})-(\d{{2}})(?:[T ](\d{{2}})(?::(\d{{2}})(?::(\d{{2}}){_FRACTION})?)?{_ZONE})?"
    rf"|(\d{{4}})(\d{{2}})(\d{{2}})(?:[T ](\d{{2}})(?:(\d{{2}})(?:(\d{{2}}){_FRACTION})?)?{_ZONE})?)$"
)
# In front of what fits; then day, clock and zone, of which only one alternative's groups are filled.
_FITS = "\x01"
ISO_LAYOUT = _FITS + "$1$8-$2$9-$3$10 $4$11:$5$12:$6$13 $7$14"
TRAILING_MARKS = ".,!?:;"
CAPTION_STARTS = ("Photo by ", "Photo shared by ")
SITE = "https://www.instagram.com"

# Accounts known to be shops or platforms.
PLATFORM_ACCOUNTS = (
    "musinsa",
    "musinsa.official",
    "29cm_official",
    "wconceptkorea",
    "wconcept",
    "ably_official",
    "zigzag_official",
    "brandi_hq",
    "kream.official",
    "lotteon_fashion",
    "lottefashion_official",
    "galleria_dept",
    "hyundaidept_official",
    "shinsegaedfs",
    "ssg_com",
    "handsome_official",
    "kasina",
    "boontheshop",
    "10cursedmen",
    "thecornerkorea",
)

# Profile texts that mark a business, lower case.
BUSINESS_KEYWORDS = (
    "의류(브랜드)",
    "clothing (brand)",
    "clothing brand",
    "쇼핑 및 소매",
    "shopping & retail",
    "부티크",
    "boutique store",
    "소매 회사",
    "retail company",
    "패션 디자이너",
    "fashion designer",
    "인터넷 회사",
    "internet company",
    "쇼핑하기",
    "view shop",
)

#: Posts are dated in the zone nine hours ahead of UTC, all year.
LOCAL_OFFSET_SECONDS = 9 * 3600
STREAK = 5
#: Grid positions per window partition when looking for a streak.
GRID_BLOCK = 65_536

COLLECTED = "collected"
FILTERED = "filtered"
DETAIL_FAILED = "detail_failed"
DATE_FAILED = "date_failed"
OFF_DAY = "off_day"


# ---- fields of one page ------------------------------------------------------------------


def _tokens(html: Column) -> Column:
    """Comments, text elements, tags and other markup of a page, in order."""
    return F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))


def _is_tag(token: Column, name: str) -> Column:
    """Whether a token is a start tag (or text element) of this kind."""
    return token.rlike(rf"(?is)^<{name}[\s/>]")


def page_links(html: Column, contains: str = "/p/") -> Column:
    """Link targets of a grid page: cut at ``?``, no comment links, first occurrence only.

    The page is cut into tokens as a browser does it: tags and attributes in either case, with or
    without quotes, quoted values with any signs in them; HTML comments, scripts and other elements
    of plain text hold no links.
    """
    anchors = F.filter(_tokens(html), lambda t: _is_tag(t, "a"))
    hrefs = F.transform(anchors, lambda t: _attribute(t, "href"))
    plain = F.transform(
        F.filter(hrefs, lambda h: h.contains(contains)),
        lambda h: F.split_part(h, F.lit("?"), F.lit(1)),
    )
    return F.array_distinct(F.filter(plain, lambda h: ~h.contains("/c/")))


def _unquoted(value: Column) -> Column:
    quoted = value.startswith('"') | value.startswith("'")
    return F.when(quoted, value.substr(F.lit(2), F.length(value) - 2)).otherwise(value)


def _decoded(text: Column) -> Column:
    for reference, char in REFERENCES:
        text = F.replace(text, F.lit(reference), F.lit(char))
    return text


def caption_images(images: Column) -> Column:
    """Images whose alternative text starts like a caption."""
    return F.filter(
        images,
        lambda i: i["alt"].startswith(CAPTION_STARTS[0]) | i["alt"].startswith(CAPTION_STARTS[1]),
    )


def mentions(images: Column) -> Column:
    """Mentions in the caption images, in order, without repeats or trailing marks."""
    found = F.flatten(
        F.transform(
            caption_images(images),
            lambda i: F.regexp_extract_all(i["alt"], F.lit(MENTION), F.lit(0)),
        )
    )
    return F.array_distinct(F.transform(found, lambda m: F.rtrim(m, F.lit(TRAILING_MARKS))))


def full_link(href: Column) -> Column:
    return F.when(F.coalesce(href, F.lit("")) != "", F.concat(F.lit(SITE), href)).otherwise("")


def post_id(link: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(link, POST_URL, 1), F.lit("")), F.lit(UNKNOWN))


def owner_id(href: Column, meta_desc: Column) -> Column:
    """Account from the link path, else from the description, else ``unknown``."""
    parts = F.filter(F.split(href, "/"), lambda p: p != "")
    in_path = F.when(
        (F.size(parts) >= 3) & (F.try_element_at(parts, F.lit(2)) == "p"),
        F.try_element_at(parts, F.lit(1)),
    )
    in_text = F.nullif(F.regexp_extract(meta_desc, OWNER_IN_DESCRIPTION, 1), F.lit(""))
    return F.lower(F.coalesce(in_path, in_text, F.lit(UNKNOWN)))


def display_name(meta_title: Column, insta_id: Column) -> Column:
    """Name in front of ``on Instagram:``; ``unknown`` when empty or just the account id."""
    name = F.regexp_extract(strip(F.coalesce(meta_title, F.lit(""))), NAME_IN_TITLE, 1)
    name = strip(F.btrim(strip(name), F.lit('"')))
    same = (insta_id != UNKNOWN) & (F.lower(name) == F.lower(insta_id))
    return F.when((name == "") | same, UNKNOWN).otherwise(name)


def image_src(og_image: Column, images: Column) -> Column:
    """Preview image, else the first caption image with a source, else empty."""
    candidates = F.filter(caption_images(images), lambda i: i["src"] != "")
    return F.coalesce(
        F.nullif(og_image, F.lit("")), F.try_element_at(candidates, F.lit(1))["src"], F.lit("")
    )


# ---- fields from the HTML of a page -------------------------------------------------------


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag's text, decoded; empty if it has none."""
    return _decoded(_unquoted(F.regexp_extract(tag, _attribute_pattern(name), 1)))


def _meta(tokens: Column, attribute: str, value: str) -> Column:
    """``content`` of the first meta tag with this attribute; empty if there is none."""
    matching = F.filter(
        tokens, lambda t: _is_tag(t, "meta") & (_attribute(t, attribute) == value)
    )
    return F.coalesce(_attribute(F.try_element_at(matching, F.lit(1)), "content"), F.lit(""))


def _inside(tokens: Column, name: str) -> Column:
    """The tokens between the first start tag of this kind and its end tag, if there is one."""
    opening = F.array_position(F.transform(tokens, lambda t: _is_tag(t, name)), F.lit(True))
    rest = F.slice(tokens, opening.cast("int") + 1, F.size(tokens))
    closing = F.array_position(
        F.transform(rest, lambda t: t.rlike(rf"(?i)^</{name}[\s/>]")), F.lit(True)
    )
    length = F.when(closing > 0, closing.cast("int") - 1).otherwise(F.size(tokens))
    return F.when(opening > 0, F.slice(rest, F.lit(1), length)).otherwise(F.array().cast("array<string>"))


def page_fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """``meta_title, meta_desc, og_image, time_iso, images`` of detail pages, in place of ``html``.

    Each page is cut into tokens once. The description falls back to the plain one. Images are
    those inside ``main``; the time is that of the first ``time`` tag, NULL without one. A missing
    page has empty fields.
    """
    shown = pages.withColumn("_tokens", _tokens(F.coalesce(html, F.lit(""))))
    page = F.col("_tokens")
    described = F.nullif(_meta(page, "property", "og:description"), F.lit(""))
    first_time = F.try_element_at(F.filter(page, lambda t: _is_tag(t, "time")), F.lit(1))
    images = F.transform(
        F.filter(_inside(page, "main"), lambda t: _is_tag(t, "img")),
        lambda t: F.struct(_attribute(t, "alt").alias("alt"), _attribute(t, "src").alias("src")),
    )
    return shown.withColumns(
        {
            "meta_title": _meta(page, "property", "og:title"),
            "meta_desc": F.coalesce(described, _meta(page, "name", "description")),
            "og_image": _meta(page, "property", "og:image"),
            "time_iso": F.nullif(_attribute(first_time, "datetime"), F.lit("")),
            "images": images,
        }
    ).drop("_tokens", html)


def grid_positions(snapshots: DataFrame, keys: tuple[str, ...] = ("brand_id",)) -> DataFrame:
    """Links of a grid in the order they are first seen: (keys, grid_pos from 1, href).

    ``snapshots`` has ``keys`` (a brand, or a brand and its run), ``scroll`` and ``html``. A link seen
    in an earlier scroll, or earlier on the same page, is not repeated. A grid of any length is
    numbered by a range sort, not in one task.
    """
    links = snapshots.select(
        *keys, "scroll", F.posexplode(page_links(F.col("html"))).alias("_pos", "href")
    )
    first = links.groupBy(*keys, "href").agg(F.min(F.struct("scroll", "_pos")).alias("_at"))
    ranked = rank_within(first, keys, [F.asc("_at"), F.asc("href")], "grid_pos")
    return ranked.select(*keys, "grid_pos", "href")


# ---- days --------------------------------------------------------------------------------


def local_day(instant: Column) -> Column:
    """Day of an instant, nine hours ahead of UTC."""
    seconds = F.unix_seconds(instant) + F.lit(LOCAL_OFFSET_SECONDS)
    return F.date_from_unix_date(F.floor(seconds / F.lit(86_400)).cast("int"))


def batch_day(instant: Column) -> Column:
    """Day a run collects, as ``yyyy-MM-dd``."""
    return F.date_format(local_day(instant), "yyyy-MM-dd")


def file_day(instant: Column) -> Column:
    """Day in the name of the file a run writes: the UTC day, as ``yyyyMMdd``."""
    day = F.date_from_unix_date(F.floor(F.unix_seconds(instant) / F.lit(86_400)).cast("int"))
    return F.date_format(day, "yyyyMMdd")


def next_day(day: Column) -> Column:
    return F.date_add(day, 1)


def last_day(day: Column) -> Column:
    return F.date_sub(day, 1)


def _description_date(meta_desc: Column) -> Column:
    return F.nullif(F.regexp_extract(meta_desc, DATE_IN_DESCRIPTION, 1), F.lit(""))


def _with(value: Column, work: Callable[[Column], Column]) -> Column:
    """``work`` of a value that is worked out once.

    Spark puts a column's expression in each place that uses it, so one used n times, nested, is
    worked out again and again; the variable of a lambda is not.
    """
    return F.transform(F.array(value), work)[0]


def iso_instant(text: Column) -> Column:
    """An ISO 8601 date or date and time, extended or basic, as an instant; NULL for other texts.

    One pattern puts the parts of a text that fits into one layout, and nothing else is searched.
    A text without a zone is read as UTC, so neither the session's zone nor its day counts.
    The pattern and each cut are worked out once a row, however often their parts are used.
    """
    def instant(parts: Column, clock: Column) -> Column:
        zone = parts[2]
        hour, minute, second = (F.coalesce(F.nullif(clock[i], F.lit("")), F.lit("00")) for i in range(3))
        shift = F.when((zone == "") | (zone == "Z"), F.lit("Z")).otherwise(
            F.concat(F.left(zone, F.lit(3)), F.lit(":"),
                     F.when(F.length(zone) > 3, F.right(zone, F.lit(2))).otherwise(F.lit("00")))
        )
        return F.try_to_timestamp(
            F.concat(parts[0], F.lit("T"), F.concat_ws(":", hour, minute, second), shift))

    def laid_out(found: Column) -> Column:
        cut = F.split(F.substring(found, len(_FITS) + 1, 2**31 - 1), " ")
        return F.when(found.startswith(_FITS) & ~text.startswith(_FITS), _with(
            cut, lambda parts: _with(F.split(parts[1], ":"), lambda clock: instant(parts, clock))))

    return _with(F.regexp_replace(text, ISO_TEXT, ISO_LAYOUT), laid_out)


def post_date(time_iso: Column, meta_desc: Column) -> Column:
    """Local day of the page's time, else the date in the description as it stands.

    A description date that is no real date fails the page; no date at all fails just the date.
    """
    written = F.try_to_timestamp(_description_date(meta_desc), F.lit("MMMM d, yyyy"))
    return F.coalesce(local_day(iso_instant(time_iso)), written.cast("date"))


# ---- filters -----------------------------------------------------------------------------


def is_self_tag(insta_id: Column, brand_id: Column) -> Column:
    return F.lower(insta_id) == F.lower(brand_id)


def drop_self_tags(posts: DataFrame) -> DataFrame:
    """Drop the brand's own posts."""
    return posts.filter(~is_self_tag(F.col("insta_id"), F.col("brand_id")))


def drop_platforms(posts: DataFrame, accounts: tuple[str, ...] = PLATFORM_ACCOUNTS) -> DataFrame:
    """Drop posts of listed accounts; the fixed list is a filter, not a join."""
    return posts.filter(~F.col("insta_id").isin(*accounts))


def business_accounts(profiles: DataFrame) -> DataFrame:
    """Accounts whose profile text holds a business keyword, each judged once.

    All keywords are sought in one pass over a text.
    """
    hit = F.lower("body_text").rlike("|".join(rf"\Q{k}\E" for k in BUSINESS_KEYWORDS))
    return (
        profiles.filter(hit & (F.col("insta_id") != UNKNOWN)).select("insta_id").distinct()
    )


def _own_join_key(df: DataFrame) -> Column:
    """The account to look up; ``unknown`` matches nothing, so each such row gets its own key.

    Posts without a known author can be a large share of all. With keys of their own they spread
    over all tasks of a shuffled join.
    """
    own = F.concat(F.lit("\u0000"), F.xxhash64(*df.columns).cast("string"))
    return F.when(F.col("insta_id") == UNKNOWN, own).otherwise(F.col("insta_id"))


def profiles_of(
    posts: DataFrame, profiles: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Profiles of the owners of ``posts``, so that no other profile text is searched."""
    owners = held(posts.filter(F.col("insta_id") != UNKNOWN).select("insta_id").distinct())
    return keep_matching(profiles, owners, "insta_id", broadcast_rows)


def drop_business(
    posts: DataFrame, profiles: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Drop posts of business accounts; a missing profile and ``unknown`` are kept."""
    business = held(business_accounts(profiles))
    if business.fits(broadcast_rows):
        return drop_matching(posts, business, "insta_id", broadcast_rows)
    keyed = posts.withColumn("_account", _own_join_key(posts))
    keys = replace(business, df=business.df.withColumnRenamed("insta_id", "_account"))
    return drop_matching(keyed, keys, "_account", broadcast_rows).drop("_account")


def _with_business_flag(
    pages: DataFrame, profiles: DataFrame, broadcast_rows: int
) -> DataFrame:
    """``_business``: whether the page's owner is a business account."""
    business = held(business_accounts(profiles))
    flags = business.df.select(F.col("insta_id").alias("_account"), F.lit(True).alias("_business"))
    spread = not business.fits(broadcast_rows)
    keyed = pages.withColumn("_account", _own_join_key(pages) if spread else F.col("insta_id"))
    return (
        keyed.join(replace(business, df=flags).prepared(broadcast_rows), "_account", "left")
        .withColumn("_business", F.coalesce("_business", F.lit(False)))
        .drop("_account")
    )


#: Day that a page's run collects; a run without one collects all days.
TARGET = "target_day"


def _with_target(rows: DataFrame, target_day: str | None) -> DataFrame:
    """``target_day`` per row: that of the row's run if it has one, else the given one."""
    if TARGET in rows.columns:
        return rows.withColumn(TARGET, F.col(TARGET).cast("date"))
    return rows.withColumn(TARGET, F.lit(target_day).cast("date"))


def _run_keys(rows: DataFrame) -> list[str]:
    """What tells one grid from another."""
    return ["brand_id", "run_id"] if "run_id" in rows.columns else ["brand_id"]


def on_day(posts: DataFrame, target_day: str | None = None) -> DataFrame:
    """Keep posts of the target day; no target keeps all."""
    if target_day is None and TARGET not in posts.columns:
        return posts
    kept = _with_target(posts, target_day).filter(
        F.col(TARGET).isNull() | (F.col("post_date") == F.col(TARGET))
    )
    return kept if TARGET in posts.columns else kept.drop(TARGET)


# ---- end of a grid -----------------------------------------------------------------------


def streak_ends(
    rows: DataFrame, target_day: str | None = None, streak: int = STREAK, block: int = GRID_BLOCK
) -> DataFrame:
    """Per grid the position of the ``streak``-th older post in a row, if there is one.

    A grid is one brand's, or that of a brand's run where rows have a ``run_id``; runs may each have
    a ``target_day``. Rows without a date neither count nor reset. A grid is cut into blocks of
    positions and each block is walked on its own; only a short summary per block (first full
    streak, the first older posts before any reset, older posts at its end) is carried along the
    grid. So no window holds more than ``block`` positions or one summary row per block.
    """
    keys = _run_keys(rows)
    older = F.col("post_date") < F.col(TARGET)
    dated = _with_target(rows, target_day).filter(
        F.col("post_date").isNotNull() & F.col(TARGET).isNotNull()
    ).select(
        *keys,
        "grid_pos",
        F.floor(F.col("grid_pos") / F.lit(block)).alias("_block"),
        older.alias("_older"),
    )
    walk = Window.partitionBy(*keys, "_block").orderBy("grid_pos")
    runs = dated.withColumn("_run", F.sum((~F.col("_older")).cast("int")).over(walk))
    in_run = Window.partitionBy(*keys, "_block", "_run").orderBy("grid_pos")
    counted = runs.withColumn("_streak", F.sum(F.col("_older").cast("int")).over(in_run))

    def at(length: int, leading: bool) -> Column:
        hit = F.col("_older") & (F.col("_streak") == length)
        return F.min(F.when(hit & (F.col("_run") == 0) if leading else hit, F.col("grid_pos")))

    blocks = counted.groupBy(*keys, "_block").agg(
        at(streak, leading=False).alias("_hit"),
        *(at(k, leading=True).alias(f"_lead{k}") for k in range(1, streak)),
        F.max("_run").alias("_resets"),
        F.max_by("_streak", "grid_pos").alias("_tail"),
    )
    along = Window.partitionBy(*keys).orderBy("_block")
    islands = blocks.withColumn(
        "_island", F.sum((F.col("_resets") > 0).cast("int")).over(along)
    ).withColumn(
        "_out", F.sum("_tail").over(Window.partitionBy(*keys, "_island").orderBy("_block"))
    )
    carried = islands.withColumn("_in", F.coalesce(F.lag("_out").over(along), F.lit(0)))
    continued = F.coalesce(
        F.lit(None),
        *(F.when(F.col("_in") == streak - k, F.col(f"_lead{k}")) for k in range(1, streak)),
    )
    return (
        carried.groupBy(*keys)
        .agg(F.min(F.least("_hit", continued)).alias("end_pos"))
        .filter(F.col("end_pos").isNotNull())
    )


def cut_at_streak(
    rows: DataFrame,
    target_day: str | None = None,
    streak: int = STREAK,
    block: int = GRID_BLOCK,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows in front of each grid's streak of older posts."""
    if target_day is None and TARGET not in rows.columns:
        return rows
    ends = held(streak_ends(rows, target_day, streak, block))
    return (
        rows.join(ends.prepared(broadcast_rows), _run_keys(rows), "left")
        .filter(F.col("end_pos").isNull() | (F.col("grid_pos") < F.col("end_pos")))
        .drop("end_pos")
    )


# ---- the whole step ----------------------------------------------------------------------


def dated_pages(fetched: DataFrame) -> DataFrame:
    """Fetched pages with their ``post_date`` and whether the page failed."""
    opened = F.coalesce(F.col("page_ok"), F.lit(True))
    day = post_date(F.col("time_iso"), F.col("meta_desc"))
    return fetched.withColumn("_day", day).withColumns(
        {
            "page_failed": ~opened
            | (F.col("_day").isNull() & _description_date(F.col("meta_desc")).isNotNull()),
            "post_date": F.when(opened, F.col("_day")),
        }
    ).drop("_day", "page_ok", "time_iso")


def visited_pages(
    fetched: DataFrame, target_day: str | None, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Dated pages up to the end of each grid; only days are worked out to find it."""
    return cut_at_streak(dated_pages(fetched), target_day, broadcast_rows=broadcast_rows)


def page_records(dated: DataFrame) -> DataFrame:
    """All record fields of each dated page, with its grid position and its run, if it has one.

    Fields that others build on are columns of a first step, so each is worked out once.
    """
    run = [c for c in ("run_id", TARGET) if c in dated.columns]
    base = dated.select(
        *run,
        "brand_id",
        "brand_name",
        "grid_pos",
        "page_failed",
        "post_date",
        "meta_title",
        owner_id(F.col("href"), F.col("meta_desc")).alias("insta_id"),
        full_link(F.col("href")).alias("full_link"),
        image_src(F.col("og_image"), F.col("images")).alias("img_src"),
        mentions(F.col("images")).alias("_tags"),
    )
    return base.select(
        *run,
        "brand_id",
        "brand_name",
        "grid_pos",
        "page_failed",
        "post_date",
        post_id(F.col("full_link")).alias("post_id"),
        "insta_id",
        display_name(F.col("meta_title"), F.col("insta_id")).alias("insta_name"),
        "full_link",
        "img_src",
        F.concat_ws(",", "_tags").alias("tagged_insta_id"),
        F.size("_tags").alias("tagged_insta_id_cnt"),
    )


def collect_posts(
    fetched: DataFrame,
    profiles: DataFrame | None = None,
    target_day: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    filter_self_tag: bool = True,
    filter_business: bool = True,
) -> DataFrame:
    """The records of collection runs, in the batch columns.

    Pages of other days and failed pages are gone before any field but the day is read. The two
    switches turn off the filter of a brand's own posts, and that of shops (listed platforms and
    business profiles).
    """
    return _collected(
        fetched, profiles, target_day, broadcast_rows, filter_self_tag, filter_business
    ).select(*BATCH_COLUMNS)


def collect_runs(
    fetched: DataFrame,
    runs: DataFrame,
    profiles: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    filter_self_tag: bool = True,
    filter_business: bool = True,
) -> DataFrame:
    """Records of many runs at once: ``run_id`` and the batch columns.

    ``runs`` has one row (brand_id, run_id, target_day) per run, and ``fetched`` the run of each
    page. Pages of a run that is not listed are left out. A run without a day collects all days.
    """
    days = held(runs.select("brand_id", "run_id", F.col(TARGET).cast("date").alias(TARGET)))
    of_runs = fetched.join(days.prepared(broadcast_rows), ["brand_id", "run_id"])
    return _collected(
        of_runs, profiles, None, broadcast_rows, filter_self_tag, filter_business
    ).select("run_id", *BATCH_COLUMNS)


def _collected(
    fetched: DataFrame,
    profiles: DataFrame | None,
    target_day: str | None,
    broadcast_rows: int,
    filter_self_tag: bool,
    filter_business: bool,
) -> DataFrame:
    pages = on_day(visited_pages(fetched, target_day, broadcast_rows), target_day).filter(
        ~F.col("page_failed") & F.col("post_date").isNotNull()
    )
    records = page_records(pages)
    if filter_self_tag:
        records = drop_self_tags(records)
    if filter_business:
        records = drop_platforms(records)
        if profiles is not None:
            # Held: owners and the kept records both come from the records of this day.
            records = held(records).df
            judged = profiles_of(records, profiles, broadcast_rows)
            records = drop_business(records, judged, broadcast_rows)
    return records.withColumn("post_date", F.col("post_date").cast("string"))


def judged_pages(
    fetched: DataFrame,
    profiles: DataFrame | None = None,
    target_day: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Visited pages, each with its owner and its ``outcome``."""
    day = F.lit(target_day).cast("date")
    pages = visited_pages(fetched, target_day, broadcast_rows).select(
        "brand_id",
        "grid_pos",
        "post_date",
        owner_id(F.col("href"), F.col("meta_desc")).alias("insta_id"),
        F.when(F.col("page_failed"), DETAIL_FAILED)
        .when(F.col("post_date").isNull(), DATE_FAILED)
        .when(day.isNotNull() & (F.col("post_date") != day), OFF_DAY)
        .alias("_early"),
    )
    own = is_self_tag(F.col("insta_id"), F.col("brand_id"))
    unwanted = own | F.col("insta_id").isin(*PLATFORM_ACCOUNTS)
    if profiles is not None:
        judged = profiles_of(pages, profiles, broadcast_rows)
        pages = _with_business_flag(pages, judged, broadcast_rows)
        unwanted = unwanted | F.col("_business")
    outcome = F.coalesce("_early", F.when(unwanted, FILTERED).otherwise(COLLECTED))
    return pages.withColumn("outcome", outcome).drop("_early", "_business")


def outcome_counts(judged: DataFrame) -> DataFrame:
    """Pages per brand and outcome; pages of another day are skipped, not counted."""
    return (
        judged.filter(F.col("outcome") != OFF_DAY)
        .groupBy("brand_id", "outcome")
        .agg(F.count(F.lit(1)).alias("pages"))
    )
