"""Page queries: the given pages, and pages written out from table rows and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.catalog.model_queries import enriched
from matchloom.catalog.registry import query
from matchloom.functions import cells, dates, text
from matchloom.operators import lifecycle as lc
from matchloom.operators import pages as pg
from matchloom.operators import paging
from matchloom.operators.markup import staged
from matchloom.operators.quality import split_errors
from matchloom.session import settle, spread
from matchloom.sources import adapter, render
from matchloom.sources.tables import raw_table

NOW = "2024-02-01 00:00:00"


def _now():
    return F.expr(f"timestamp_ntz'{NOW}'")


def _pages(spark, sf):
    return raw_table(spark, sf, "pages")


@query("page_links", """
    select page_id, url, cast(n - 1 as integer) as pos, links[n] as href, links[n][2:] as link_text
    from (select page_id, url, regexp_extract_all(html, '<a href="([^"]*)">', 1) as links from pages),
      unnest(range(1, len(links) + 1)) as t(n)""")
def _(spark, sf):
    return pg.page_links(_pages(spark, sf))


@query("page_triage", """
    with varied as (select page_id, url, case page_id % 4
        when 0 then concat('<title>Just a moment...</title>', html, 'Checking your BROWSER')
        when 1 then concat('<div id="a" class="box match-info-box">', html)
        when 2 then concat('<div class="match-info-boxes">', html) else html end as html from pages)
    select page_id, url, status, retryable, markers, page_length, snippet from (
      select page_id, url, case page_id % 4 when 1 then 'ok' when 0 then 'blocked' else 'missing_content' end as status,
        page_id % 4 <> 1 as retryable,
        case page_id % 4 when 0 then 'checking_your_browser,just_a_moment' else '' end as markers,
        length(html) as page_length, left(trim(regexp_replace(html, '\\s+', ' ', 'g')), 300) as snippet from varied)""")
def _(spark, sf):
    html, turn = F.col("html"), F.col("page_id") % 4
    varied = _pages(spark, sf).withColumn("html", (
        F.when(turn == 0, F.concat(F.lit("<title>Just a moment...</title>"), html, F.lit("Checking your BROWSER")))
         .when(turn == 1, F.concat(F.lit('<div id="a" class="box match-info-box">'), html))
         .when(turn == 2, F.concat(F.lit('<div class="match-info-boxes">'), html)).otherwise(html)))
    return pg.triage(varied).select(
        "page_id", "url", "status", "retryable", F.array_join("markers", ",").alias("markers"),
        F.col("page_length").cast("bigint").alias("page_length"), "snippet")


@query("page_keys", """
    select page_id, try_cast(nullif(regexp_extract(url, '/(\\d+)', 1), '') as bigint) as path_key,
      coalesce(nullif(regexp_extract(url, '(\\d+)', 1), ''), url) as text_key,
      try_cast(nullif(regexp_extract(url, '/matches/(\\d+)', 1), '') as bigint) as match_key from pages""")
def _(spark, sf):
    url = F.col("url")
    return _pages(spark, sf).select(
        "page_id", text.key_from_url(url, r"/(\d+)").alias("path_key"), text.text_key_from_url(url).alias("text_key"),
        text.key_from_url(url, text.MATCH_KEY).alias("match_key"))


_CELL_SQL = """
    with cell as (select l_orderkey, l_linenumber, l_suppkey, l_partkey,
      case l_partkey % 5 when 0 then concat(l_partkey % 40, '(', l_suppkey % 9, ')')
        when 1 then concat(l_partkey % 40, ' (', l_suppkey % 9, ')') when 2 then concat('', l_partkey % 40)
        when 3 then concat(l_partkey % 40, ' : ', l_suppkey % 9) else '-' end as txt from lineitem)
"""


def _cells(spark, sf):
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    main, extra = (part % 40).cast("string"), (supp % 9).cast("string")
    shape = part % 5
    cell = (F.when(shape == 0, F.concat(main, F.lit("("), extra, F.lit(")")))
             .when(shape == 1, F.concat(main, F.lit(" ("), extra, F.lit(")"))).when(shape == 2, main)
             .when(shape == 3, F.concat(main, F.lit(" : "), extra)).otherwise("-"))
    return raw_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", cell.alias("txt"))


@query("cell_pairs", f"""{_CELL_SQL}
    select l_orderkey, l_linenumber, l_suppkey, l_partkey,
      case when l_partkey % 5 < 4 then l_partkey % 40 end as main,
      case when l_partkey % 5 < 2 then l_suppkey % 9 when l_partkey % 5 < 4 then 0 end as extra,
      case when l_partkey % 5 = 3 then l_partkey % 40 else 0 end as colon_left,
      case when l_partkey % 5 = 3 then l_suppkey % 9 else 0 end as colon_right, l_partkey % 5 <> 3 as colon_defaulted,
      case when l_partkey % 5 = 4 then 0 else l_partkey % 40 end as whole_value, l_partkey % 5 = 4 as whole_defaulted
    from cell""")
def _(spark, sf):
    main, extra = cells.pair(F.col("txt"))
    left, right, colon_defaulted = cells.colon_pair(F.col("txt"))
    value, defaulted = cells.int_cell(F.col("txt"))
    return _cells(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", main.alias("main"), extra.alias("extra"),
        left.alias("colon_left"), right.alias("colon_right"), colon_defaulted.alias("colon_defaulted"),
        value.alias("whole_value"), defaulted.alias("whole_defaulted"))


@query("percent_cells", """
    select l_orderkey, l_linenumber, l_suppkey, l_partkey,
      case when l_partkey % 7 = 0 then 0 else cast(l_partkey % 2001 - 1000 as double) / 10000 end as swing,
      l_partkey % 7 = 0 as swing_defaulted,
      case when l_suppkey % 6 <> 0 then cast(l_partkey % 1000 as double) / 1000 end as kast,
      case when l_suppkey % 6 <> 0 then cast(l_partkey % 300 as double) / 100 end as rating from lineitem""")
def _(spark, sf):
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    swing_text = F.when(part % 7 == 0, "n/a").otherwise(
        F.format_string("%+.2f%%", (part % 2001 - 1000).cast("double") / 100))
    kast_text = F.when(supp % 6 == 0, "N/A").otherwise(
        F.format_string("%.1f%%", (part % 1000).cast("double") / 10))
    rating_text = F.when(supp % 6 == 0, "-").otherwise(
        F.concat(F.lit("-"), F.format_string("%.2f", (part % 300).cast("double") / 100)))
    swing, defaulted = cells.percent_cell(swing_text)
    return raw_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", swing.alias("swing"),
        defaulted.alias("swing_defaulted"), cells.ratio(kast_text).alias("kast"), cells.rating(rating_text).alias("rating"))


@query("headline_dates", """
    select o_orderkey, case when o_orderkey % 13 <> 0 then cast(o_orderdate as date) end as headline_date,
      cast(o_orderdate as date) as page_date,
      case when o_orderkey % 2 = 0 then concat(strftime(o_orderdate, '%Y-%m-%d'), ' 14:30:00')
           else strftime(o_orderdate, '%Y-%m-%d') end as text_date,
      concat(strftime(o_orderdate, '%Y-%m-%d'), ' 00:00:00') as unix_date
    from orders""")
def _(spark, sf):
    orders, order = raw_table(spark, sf, "orders"), F.col("o_orderkey")
    head = F.when(order % 13 == 0, "Results for not-a-date").otherwise(render.headline(F.col("o_orderdate")))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    free = F.concat(F.lit("played on "), day, F.when(order % 2 == 0, " 14:30").otherwise(" late"), F.lit(" in x"))
    moment = dates.from_millis(F.unix_millis(F.col("o_orderdate").cast("timestamp")))
    return orders.select(
        "o_orderkey", dates.headline_date(head).alias("headline_date"),
        dates.parse_stamp(dates.text_date(free)).cast("date").alias("page_date"),
        dates.text_date(free).alias("text_date"), dates.stamp(moment).alias("unix_date"))


@query("best_of_types", """
    select match_id, match_type, forfeit from matches""", "matches")
def _(spark, sf):
    rows = adapter.matches(spark, sf)
    label = F.concat(F.lit("best of "), F.substring("match_type", 3, 1), F.lit("\nround 5"))
    name = F.when(F.col("forfeit"), " DEFAULT ").otherwise("Nuke")
    return rows.select("match_id", text.best_of(label).alias("match_type"), text.is_forfeit(name).alias("forfeit"))


_START, _END = "1996-01-01", "2000-12-31"


def _dates():
    return F.lit(_START).cast("date"), F.lit(_END).cast("date")


@query("result_links", f"""
    select match_id, concat('https://example.test/matches/', match_id, '/a-vs-b') as match_url,
      match_id as page_id, 0 as section, 0 as pos from matches
    where match_id % 13 <> 0 and cast(date as date) between date '{_START}' and date '{_END}'""", "matches")
def _(spark, sf):
    return pg.discover_links(render.results_pages(spread(adapter.matches(spark, sf), "match_id")), *_dates())


@query("discovery_cap", f"""
    select match_id, concat('https://example.test/matches/', match_id, '/a-vs-b') as match_url,
      match_id as page_id, 0 as section, 0 as pos from matches
    where match_id % 13 <> 0 and cast(date as date) between date '{_START}' and date '{_END}'
    order by match_id limit 50""", "matches")
def _(spark, sf):
    return pg.discover_links(render.results_pages(spread(adapter.matches(spark, sf), "match_id")), *_dates(), limit=50)


# Sections of a page by falling date; the undated one stands first. The scan ends in the page of the newest day before the start.
_LISTED = f"""
    with placed as (select match_id, cast(date as date) as day, date_diff('day', cast(date as date), date '2030-01-01') // 5 * 1000000
        + match_id // 20000 as page_id, match_id % 13 = 0 as undated from matches where date is not null),
    found as (select *, cast(dense_rank() over (partition by page_id order by undated desc, case when not undated then day end desc) - 1 as integer) as section,
        cast(row_number() over (partition by page_id, undated, case when not undated then day end order by match_id) - 1 as integer) as pos from placed),
    hits as (select match_id, concat('https://example.test/matches/', match_id, '/a-vs-b') as match_url, page_id, section, pos
      from found where not undated and day between date '{_START}' and date '{_END}'
        and page_id <= coalesce((select min(page_id) from found where not undated and day < date '{_START}'), page_id))"""


def _listing(spark, sf):
    return settle(spread(render.results_listing(adapter.matches(spark, sf)), "page_id"), "listing")


@query("paged_discovery", f"""{_LISTED}
    select match_id, match_url, page_id, section, pos, 'discovered' as status, 'results' as source from hits""", "matches")
def _(spark, sf):
    """All matches of a range of dates from pages with several sections; the scan ends with the first page that holds an older one."""
    found = paging.scan_pages(_listing(spark, sf), *_dates(), empty_ends=False).links
    return lc.discovery_rows(found, _now(), "results").select(*paging.LINK, "status", "source")


@query("paged_discovery_cap", f"""{_LISTED}
    select * from hits order by page_id, section, pos limit 1000""", "matches")
def _(spark, sf):
    return paging.scan_pages(_listing(spark, sf), *_dates(), limit=1000, empty_ends=False).links


def _parsed_matches(spark, sf):
    return pg.parse_match_pages(render.match_pages(spread(adapter.matches(spark, sf), "match_id")), _now())


@query("match_pages", f"""
    select match_id, match_url, team1, team2, score1, score2, winner, event, match_type, forfeit, date,
      timestamp '{NOW}' as last_updated_at, true as data_complete, 1 + match_id % 3 as maps,
      case when match_id % 4 = 0 then concat('', match_id) end as demo_id
    from matches where match_id % 17 <> 0""", "matches")
def _(spark, sf):
    good, _bad = split_errors(_parsed_matches(spark, sf))
    return good.withColumns({
        "maps": F.size("map_links").cast("bigint"), "demo_id": F.get("demo_links", F.lit(0))["demo_id"],
    }).drop("map_links", "demo_links", "last_inserted_at", "last_scraped_at")


@query("match_page_rejects", """
    select match_url as url, 'event name missing' as error from matches where match_id % 17 = 0""", "matches")
def _(spark, sf):
    return pg.rejected_pages(_parsed_matches(spark, sf), "match_url")


@query("map_followups", f"""
    select match_id * 10 + n as map_id, concat('https://example.test/stats/matches/mapstatsid/', match_id * 10 + n, '/x') as map_url,
      match_id, n as map_order, 'discovered' as status, 'match_parser' as source, cast(0 as bigint) as priority,
      timestamp '{NOW}' as first_seen_at
    from (select match_id, unnest(range(1, 2 + match_id % 3)) as n from matches)""", "matches")
def _(spark, sf):
    found = lc.discovery_rows(pg.map_followups(adapter.matches(spark, sf)), _now(), "match_parser")
    return found.drop("failure_count", "last_seen_at", "last_updated_at")


@query("demo_followups", """
    select concat('', match_id) as demo_id, concat('https://example.test/download/demo/', match_id, '/x') as demo_url, match_id
    from matches where match_id % 4 = 0""", "matches")
def _(spark, sf):
    return pg.demo_followups(adapter.matches(spark, sf))


@query("map_order_inference", """
    select match_id, match_id * 10 + n as map_id, n as map_order
    from (select match_id, unnest(range(1, 2 + match_id % 3)) as n from matches)
    union all select match_id, -1, null from matches""", "matches")
def _(spark, sf):
    rows = spread(adapter.matches(spark, sf), "match_id")
    # Every link is on the page twice, as it would be with a second navigation bar.
    pages = render.match_pages(rows).select("page_id", F.concat("html", "html").alias("html"))
    ids = staged(pg.outlined(pages), "page_id", pg.linked_map_ids(F.col("nodes")).alias("ids"))
    asked = ids.select("page_id", "ids", F.explode(F.concat("ids", F.array(F.lit(-1).cast("bigint")))).alias("map_id"))
    return asked.select(F.col("page_id").alias("match_id"), "map_id",
                        pg.ordinal_in(F.col("ids"), F.col("map_id")).alias("map_order"))


def _parsed_maps(spark, sf):
    return pg.parse_map_pages(render.map_pages(spread(enriched(spark, sf), "map_id")), _now())


# A page with a row whose rating cannot be read is rejected as a whole; unreadable multi-kills count as 0.
_GOOD_MAPS = """
    select map_id from enriched group by map_id having bool_and(rating is not null)"""


@query("map_pages_players", f"""
    select map_id, player_id, player_name, player_url, map_name, coalesce(team_name, 'Unknown') as team_name, kills, headshots, assists, flash_assists,
      deaths, traded_deaths, opening_kills, opening_deaths, case when player_id % 10 = 9 then 0 else multi_kills end as multi_kills,
      clutches_won, kast, kd_diff, adr, fk_diff,
      round_swing, rating, timestamp '{NOW}' as last_inserted_at, timestamp '{NOW}' as last_scraped_at,
      timestamp '{NOW}' as last_updated_at, true as data_complete
    from enriched where map_id in ({_GOOD_MAPS})""", "enriched")
def _(spark, sf):
    return pg.player_rows(_parsed_maps(spark, sf))


@query("map_pages_maps", f"""
    select m.map_id, m.match_id, m.map_url, m.map_order, m.map_name, team1_score, team2_score, m.map_winner, m.date,
      timestamp '{NOW}' as inserted_at, timestamp '{NOW}' as last_scraped_at, timestamp '{NOW}' as last_updated_at,
      true as data_complete
    from maps m where m.map_id in ({_GOOD_MAPS})""", "enriched")
def _(spark, sf):
    return pg.map_rows(_parsed_maps(spark, sf))


@query("map_page_rejects", f"""
    select m.map_url as url, 'rating unreadable' as error from maps m
    where m.map_id in (select map_id from enriched) and m.map_id not in ({_GOOD_MAPS})""", "enriched")
def _(spark, sf):
    return pg.rejected_pages(_parsed_maps(spark, sf), "map_url")


@query("map_page_warnings", f"""
    select map_id, player_id, 'multi-kills' as metric from enriched where player_id % 10 = 9 and map_id in ({_GOOD_MAPS})""", "enriched")
def _(spark, sf):
    return pg.defaulted_metrics(_parsed_maps(spark, sf))
