"""Page jobs: triage, link discovery, match pages and map pages to typed rows.

A page is one row, and everything read from it stays in that row until the
final ``explode``; no job here shuffles. Steps go through ``markup.staged`` so
that each column is worked out once. The texts of a map page, of which there
are many, are picked while it is walked (``map_texts``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions import cells, dates, text
from matchloom.functions.scalar import winner_of
from matchloom.operators import markup as k
from matchloom.operators.map_texts import HIDDEN, METRICS, SCORE_STOPS, UNKNOWN_TEAM, map_texts

SITE = "https://example.test"

def triage(pages: DataFrame, tag: str = "div", css_class: str = "match-info-box") -> DataFrame:
    """Page status before parsing: ok, blocked or missing_content; the last two may be retried."""
    has = text.holds_element(F.col("html"), tag, css_class)
    marked = pages.withColumns({"has_content": has, "markers": text.markers_in(F.col("html"))})
    status = (F.when(F.col("has_content"), "ok").when(F.size("markers") > 0, "blocked")
               .otherwise("missing_content"))
    return marked.withColumns({
        "status": status, "retryable": status != "ok",
        "page_length": F.length(F.coalesce("html", F.lit(""))), "snippet": text.snippet(F.col("html"))})


def outlined(pages: DataFrame) -> DataFrame:
    """Pages with their nodes; the raw page is not carried further."""
    kept = [c for c in pages.columns if c != "html"]
    return pages.select(*kept, k.outline("html").alias("nodes"))


def page_links(pages: DataFrame) -> DataFrame:
    """Every link of every page with its position and text."""
    found = F.transform(
        F.filter(k.select(F.col("nodes"), "a"), lambda a: a["href"].isNotNull()),
        lambda a: F.struct(a["href"].alias("href"), k.text_of(F.col("nodes"), a, " ").alias("link_text")))
    listed = k.staged(outlined(pages), "page_id", "url", found.alias("links"))
    return listed.select("page_id", "url", F.posexplode("links").alias("pos", "link")).select(
        "page_id", "url", "pos", "link.*")


# -- results pages -----------------------------------------------------------

def result_links(pages: DataFrame, site: str = SITE) -> DataFrame:
    """Links of each dated section; ``match_date`` is null under an unreadable headline."""
    nodes, body = F.col("nodes"), F.col("body")
    listed = k.staged(outlined(pages), "page_id", F.transform(
        k.select(nodes, "div", "results-sublist"), lambda part: k.inside(nodes, part)).alias("bodies"))
    bodies = listed.select("page_id", F.posexplode("bodies").alias("section", "body"))
    headline = k.first(k.select(body, "div", "standard-headline"))
    hrefs = F.array_compact(F.transform(
        k.select(body, "div", "result-con"),
        lambda r: k.first(F.filter(k.select(k.inside(body, r), "a"), lambda a: a["href"].isNotNull()))["href"]))
    headed = k.staged(bodies, "page_id", "section", headline.isNotNull().alias("headed"),
                      k.raw_text_of(body, headline).alias("headline"), hrefs.alias("hrefs"))
    dated = k.staged(headed.filter("headed"), "page_id", "section", "headline", "hrefs",
                     dates.headline_date(F.col("headline")).alias("match_date"))
    links = dated.select("page_id", "section", "headline", "match_date", F.posexplode("hrefs").alias("pos", "href"))
    url = F.concat(F.lit(site), F.col("href"))
    return links.select(
        "page_id", "section", "pos", "headline", "match_date", url.alias("match_url"),
        text.key_from_url(url, text.MATCH_KEY).alias("match_id"))


def in_range(links: DataFrame, start: Column, end: Column) -> DataFrame:
    """Links dated inside the range; undated ones drop out."""
    return links.filter(F.col("match_date").between(start, end))


def discover_links(pages: DataFrame, start: Column, end: Column, limit: int | None = None,
                   site: str = SITE) -> DataFrame:
    """Match ids and urls to record, the first ``limit`` with an id in page order."""
    links = in_range(result_links(pages, site), start, end).filter(F.col("match_id").isNotNull())
    if limit is not None:
        links = links.orderBy("page_id", "section", "pos").limit(limit)
    return links.select("match_id", "match_url", "page_id", "section", "pos")


# -- match pages -------------------------------------------------------------

def parse_match_pages(pages: DataFrame, now: Column, site: str = SITE, keep: Sequence[str] = ()) -> DataFrame:
    """One match row per page plus ``error``; typed as the matches table, then the columns ``keep`` of the page."""
    nodes = F.col("nodes")

    def score(css_class: str) -> Column:
        link = k.first(k.select(k.inside(nodes, k.first(k.select(nodes, "div", css_class))), "a"))
        cell = k.first(k.select(k.later_siblings(nodes, link), "div"))
        return k.let(k.raw_text_of(nodes, cell), cells.whole)

    linked = F.filter(k.select(nodes, "a", "results-stats"), lambda a: a["href"].isNotNull())

    def demo_links(path: Column) -> Column:
        url = F.concat(F.lit(site), path)
        return F.when(path.isNotNull(), F.array(F.struct(
            text.text_key_from_url(url).alias("demo_id"), url.alias("demo_url")))).otherwise(F.array())

    raw = k.staged(
        outlined(pages), *keep, F.col("url").alias("match_url"),
        F.transform(F.slice(k.select(nodes, "div", "teamName"), 1, 2), lambda n: k.text_of(nodes, n)).alias("teams"),
        score("team1-gradient").alias("score1"), score("team2-gradient").alias("score2"),
        k.raw_text_of(nodes, k.first(k.select_exact(nodes, "div", "event text-ellipsis"))).alias("event"),
        k.raw_text_of(nodes, k.first(k.select_exact(nodes, "div", "padding preformatted-text"))).alias("best_of"),
        k.let(k.first(k.select(nodes, "div", "mapname")), lambda n: k.text_of(nodes, n)).alias("map_name"),
        k.first(k.select(nodes, "div", "date"))["unix"].alias("unix"),
        F.transform(linked, lambda a: F.struct(
            text.key_from_url(a["href"], text.FIRST_NUMBER).alias("map_id"),
            F.concat(F.lit(site), a["href"]).alias("map_url"))).alias("map_links"),
        k.let(k.first(k.select(nodes, "a", "stream-box"))["demo"], demo_links).alias("demo_links"))
    typed = k.staged(raw.withColumns({
        "match_id": text.key_from_url(F.col("match_url"), text.MATCH_KEY),
        "team1": F.nullif(F.get("teams", F.lit(0)), F.lit("")), "team2": F.nullif(F.get("teams", F.lit(1)), F.lit("")),
        "match_type": text.best_of(F.col("best_of")),
        "date": F.date_trunc("day", dates.from_millis(dates.millis_attr(F.col("unix")))).cast("timestamp_ntz")}), "*")
    bad_link = F.exists("map_links", lambda m: m["map_id"].isNull())
    error = F.coalesce(
        F.when(F.col("match_id").isNull(), "no match id in url"),
        F.when(F.col("team1").isNull() | F.col("team2").isNull(), "team names missing"),
        F.when(F.col("score1").isNull() | F.col("score2").isNull(), "team scores unreadable"),
        F.when(F.col("event") == "", "event name missing"),
        F.when(F.col("match_type").isNull(), "match type unreadable"),
        F.when(F.col("map_name") == "", "forfeit status missing"),
        F.when(F.col("date").isNull(), "match date unreadable"),
        F.when(bad_link, "map link without id"))
    return k.staged(
        typed, "match_id", "match_url", "map_links", "demo_links", "team1", "team2", "score1", "score2",
        winner_of(*[F.col(c) for c in ("team1", "team2", "score1", "score2")]).alias("winner"),
        "event", "match_type", text.is_forfeit(F.col("map_name")).alias("forfeit"), "date",
        now.alias("last_inserted_at"), now.alias("last_scraped_at"), now.alias("last_updated_at"),
        F.lit(True).alias("data_complete"), *keep, error.alias("error"))


def map_followups(matches: DataFrame) -> DataFrame:
    """Map links of each match with their parent and order from 1."""
    return matches.select("match_id", F.posexplode("map_links").alias("pos", "link")).select(
        "link.map_id", "link.map_url", "match_id", (F.col("pos") + 1).cast("bigint").alias("map_order"))


def demo_followups(matches: DataFrame) -> DataFrame:
    return matches.select("match_id", F.explode("demo_links").alias("link")).select(
        "link.demo_id", "link.demo_url", "match_id")


# -- map pages ---------------------------------------------------------------

def parse_map_pages(pages: DataFrame, now: Column, site: str = SITE, keep: Sequence[str] = ()) -> DataFrame:
    """One row per page with the map fields, its ``players``, ``error`` and the columns ``keep`` of the page.

    Input columns: url, html, map_id, match_id, map_order (the claim context).
    One unreadable player row rejects its page.
    """
    kept = [*keep, "url", "map_id", "match_id", "map_order"]
    t = F.col("t")
    # Pages that are written by an aggregate must not be merged into it with the texts read from them.
    written = k.staged(pages, *kept, "html")
    links = F.transform(t["links"], lambda href: text.key_from_url(href, text.MAP_KEY))
    texts = k.staged(
        written.select(*kept, map_texts("html").alias("t")), *kept, t["map_name"].alias("map_name"), t["n_tables"].alias("n_tables"),
        F.array_distinct(F.array_compact(links)).alias("linked_ids"), t["unix"].alias("unix"), dates.text_date(t["page_text"]).alias("text_date"),
        t["teams"].alias("teams"), cells.whole(t["score1"]).alias("team1_score"), cells.whole(t["score2"]).alias("team2_score"),
        F.transform(t["rows"], lambda r: _player(r, site)).alias("players"))
    return _checked_maps(texts, now, keep)


def map_texts_by_columns(pages: DataFrame, *kept: str) -> DataFrame:
    """The texts of map pages (column ``t``) as column expressions over all their nodes: what ``map_texts`` must give."""
    nodes = F.col("nodes")
    box = k.inside(nodes, k.first(k.select(nodes, "div", "match-info-box")))
    small = k.first(k.select(F.col("box"), "div", "small-text"))
    # The siblings of a node in the box are in the box.
    named = F.filter(k.later_siblings(F.col("box"), small), lambda n: n["shown"].isNotNull())
    main = k.select(nodes, "table", "stats-table", "totalstats")
    tables = k.let(main, lambda found: F.when(F.size(found) > 0, found).otherwise(
        k.select(nodes, "table", "stats-table")))
    date = k.first(k.select(nodes, "div", "date"))

    linked = F.filter(k.select(nodes, "a"), lambda a: a["href"].contains("/stats/matches/mapstatsid/"))
    found = k.staged(
        outlined(pages), *kept, "nodes", box.alias("box"), tables.alias("tables"),
        F.transform(linked, lambda a: a["href"]).alias("links"), date["unix"].alias("unix"))
    # The page text is needed only where no date attribute is given.
    sections = k.staged(
        found, *kept, k.first(named)["shown"].alias("map_name"), k.strings(F.col("box")).alias("tokens"), "links", "unix",
        F.size("tables").alias("n_tables"),
        F.when(F.col("unix").isNull(), F.array_join(k.strings(nodes), " ")).alias("page_text"),
        F.transform(
            F.filter("tables", lambda t: ~F.array_contains(t["classes"], "hidden")),
            lambda t: k.let(k.inside(nodes, t), _section)).alias("sections"))
    texts = k.staged(sections.withColumns({
        "teams": F.array_distinct(F.filter(
            F.transform("sections", lambda s: s["team"]), lambda t: t != UNKNOWN_TEAM)),
        "rows": F.flatten(F.transform("sections", lambda s: F.transform(s["rows"], lambda r: _row_texts(s, r))))}), "*")
    scores = [_score_after(F.col("tokens"), F.get("teams", F.lit(n))).alias(f"score{n + 1}") for n in range(2)]
    return texts.select(*kept, F.struct("map_name", "n_tables", "unix", "page_text", "links", "teams", *scores, "rows").alias("t"))


def _checked_maps(texts: DataFrame, now: Column, keep: Sequence[str]) -> DataFrame:
    """Map rows from typed texts, with ``error``."""
    typed = k.staged(texts.withColumns({
        "team1": F.get("teams", F.lit(0)), "team2": F.get("teams", F.lit(1)),
        "order_found": F.coalesce(
            F.nullif("map_order", F.lit(0)), ordinal_in(F.col("linked_ids"), F.col("map_id")),
            ordinal_in(F.col("linked_ids"), text.key_from_url(F.col("url"), text.MAP_KEY))),
        "date": F.when(F.col("unix").isNotNull(), F.date_trunc(
            "second", dates.from_millis(dates.millis_attr(F.col("unix")))).cast("timestamp_ntz"))
        .otherwise(dates.parse_stamp(F.col("text_date")))}), "*")
    row_errors = F.filter(F.transform("players", lambda p: p["error"]), lambda e: e.isNotNull())
    error = F.coalesce(
        F.when(F.col("map_name").isNull(), "map name missing"),
        F.when(F.col("n_tables") == 0, "no player tables"),
        F.when(F.size("teams") < 2, "map teams missing"),
        F.when(F.col("team1_score").isNull() | F.col("team2_score").isNull(), "map scores unreadable"),
        F.get(row_errors, F.lit(0)),
        F.when(F.col("match_id").isNull(), "no parent match id"),
        F.when(F.col("order_found").isNull(), "map order unknown"),
        F.when(F.col("date").isNull(), "map date unreadable"))
    return k.staged(
        typed, "map_id", "match_id", F.col("url").alias("map_url"), F.col("order_found").alias("map_order"), "map_name",
        "team1_score", "team2_score",
        winner_of(*[F.col(c) for c in ("team1", "team2", "team1_score", "team2_score")]).alias("map_winner"),
        "date", now.alias("inserted_at"), now.alias("last_scraped_at"), now.alias("last_updated_at"),
        F.lit(True).alias("data_complete"), "players", error.alias("error"), *keep)


def linked_map_ids(nodes: Column) -> Column:
    """Distinct map ids the page links to, in page order."""
    links = F.filter(k.select(nodes, "a"), lambda a: a["href"].contains("/stats/matches/mapstatsid/"))
    return F.array_distinct(F.array_compact(F.transform(
        links, lambda a: text.key_from_url(a["href"], text.MAP_KEY))))


def ordinal_in(ids: Column, wanted: Column) -> Column:
    """Place of an id from 1; null when it is not listed."""
    return F.nullif(F.array_position(ids, wanted), F.lit(0))


def _section(body: Column) -> Column:
    """Team, header names and rows of cells of one player table."""
    heading = k.first(k.select(body, "th", "st-teamname"))
    titles = F.flatten(F.transform(k.select(body, "thead"), lambda head: k.select(k.inside(body, head), "th")))
    # A header without a name stays as an empty one, which no metric asks for; ``nullif`` would work each out twice.
    headers = F.transform(titles, lambda th: text.header_key(k.text_of(body, th, " ")))
    first_body = k.first(k.select(body, "tbody"))
    rows = F.transform(
        k.select(k.inside(body, first_body), "tr"),
        lambda tr: k.let(k.inside(body, tr), _cells))
    return F.struct(
        F.when(heading.isNull(), UNKNOWN_TEAM).otherwise(k.raw_text_of(body, heading)).alias("team"),
        headers.alias("headers"),
        F.filter(rows, lambda r: F.size(r["cells"]) > 0).alias("rows"))


def _cells(row: Column) -> Column:
    """Cells of one table row, and the first link of its first cell."""
    tds = k.select(row, "td")
    found = F.transform(tds, lambda td: F.struct(
        td["classes"].alias("classes"), k.text_of(row, td, " ").alias("spaced"), k.text_of(row, td).alias("joined")))
    return k.let(k.first(k.select(k.inside(row, k.first(tds)), "a")), lambda link: F.struct(
        found.alias("cells"), link["href"].alias("href"), k.text_of(row, link).alias("link_text")))


def _metric(headers: Column, row_cells: Column, css_class: str, names: list[str], default: int) -> Column:
    """Visible cell before hidden cell before the cell in the named or default column."""
    tagged = F.filter(row_cells, lambda c: F.array_contains(c["classes"], css_class) & (c["spaced"] != ""))
    column = F.coalesce(*[F.nullif(F.array_position(headers, name), F.lit(0)) for name in names], F.lit(default + 1))
    marked = k.let(tagged, lambda cells: F.coalesce(k.first(F.filter(cells, lambda c: ~F.arrays_overlap(
        c["classes"], F.array(*[F.lit(h) for h in HIDDEN]))))["spaced"], k.first(cells)["spaced"]))
    return F.coalesce(marked, F.get(row_cells, (column - 1).cast("int"))["joined"], F.lit(""))


def _row_texts(section: Column, row: Column) -> Column:
    return F.struct(
        section["team"].alias("team_name"), row["href"].alias("href"),
        F.coalesce(F.nullif(row["link_text"], F.lit("")), F.nullif(k.first(row["cells"])["joined"], F.lit("")))
        .alias("player_name"),
        *[_metric(section["headers"], row["cells"], *spec).alias(name) for name, spec in METRICS.items()])


def _player(row: Column, site: str) -> Column:
    """Typed player fields of one row of texts, with ``error`` for the required ones. Each field is typed once."""
    return k.let(_typed_player(row, site), lambda typed: _checked_player(row, typed))


def _typed_player(row: Column, site: str) -> Column:
    url = F.concat(F.lit(site), row["href"])
    kills, headshots = cells.pair(row["kills"])
    assists, flashes = cells.pair(row["assists"])
    deaths, traded = cells.pair(row["deaths"])
    opened, lost, opening_defaulted = cells.colon_pair(row["opkd"])
    multi, multi_defaulted = cells.int_cell(row["mks"])
    clutches, clutches_defaulted = cells.int_cell(row["clutches"])
    swing, swing_defaulted = cells.percent_cell(row["swing"])
    defaulted = F.array_compact(F.array(
        F.when(opening_defaulted, "opening duels"), F.when(multi_defaulted, "multi-kills"),
        F.when(clutches_defaulted, "clutches won"), F.when(swing_defaulted, "round swing")))
    return F.struct(
        text.key_from_url(url, text.PATH_KEY).alias("player_id"), url.alias("player_url"), kills.alias("kills"), headshots.alias("headshots"),
        assists.alias("assists"), flashes.alias("flash_assists"), deaths.alias("deaths"),
        traded.alias("traded_deaths"), opened.alias("opening_kills"), lost.alias("opening_deaths"),
        multi.alias("multi_kills"), clutches.alias("clutches_won"), cells.ratio(row["kast"]).alias("kast"),
        cells.number(row["adr"]).alias("adr"), swing.alias("round_swing"), cells.rating(row["rating"]).alias("rating"),
        defaulted.alias("defaulted"))


def _checked_player(row: Column, typed: Column) -> Column:
    error = F.coalesce(
        F.when(row["player_name"].isNull(), "player name missing"),
        F.when(row["href"].isNull(), "player url missing"),
        F.when(typed["player_id"].isNull(), "player id missing"),
        *[F.when(row[n] == "", f"{n} missing").when(typed[n].isNull(), f"{n} unreadable") for n in ("kills", "assists", "deaths")],
        *[F.when(typed[n].isNull(), f"{n} unreadable") for n in ("kast", "adr", "rating")])
    fields = {
        "kd_diff": typed["kills"] - typed["deaths"], "fk_diff": typed["opening_kills"] - typed["opening_deaths"],
        "player_name": row["player_name"], "team_name": row["team_name"], "error": error}
    names = ["player_id", "player_name", "player_url", "team_name", "kills", "headshots", "assists", "flash_assists", "deaths",
             "traded_deaths", "opening_kills", "opening_deaths", "multi_kills", "clutches_won", "kast", "kd_diff", "adr", "fk_diff",
             "round_swing", "rating", "defaulted", "error"]
    return F.struct(*[(fields[name] if name in fields else typed[name]).alias(name) for name in names])


def _score_after(tokens: Column, team: Column) -> Column:
    """First whole number after the team's name, or the stop text that comes before it."""
    at = F.array_position(tokens, team).cast("int")
    tail = F.when(at > 0, F.slice(tokens, at + 1, F.size(tokens)))
    return k.first(F.filter(tail, lambda t: t.rlike(r"^\d+$") | t.isin(*SCORE_STOPS)))


def map_rows(parsed: DataFrame) -> DataFrame:
    """Map rows of the pages that parsed."""
    return parsed.filter(F.col("error").isNull()).drop("players", "error")


def player_rows(parsed: DataFrame, place: str | None = None) -> DataFrame:
    """Player rows of the pages that parsed; the audit times are the map's. ``place`` names a column for the row's place on its page."""
    good = parsed.filter(F.col("error").isNull())
    rows = good.select("map_id", "map_name", "inserted_at", "last_scraped_at", "last_updated_at", "data_complete",
                       F.posexplode("players").alias("_place", "p"))
    stats = ["kills", "headshots", "assists", "flash_assists", "deaths", "traded_deaths", "opening_kills",
             "opening_deaths", "multi_kills", "clutches_won", "kast", "kd_diff", "adr", "fk_diff", "round_swing",
             "rating"]
    return rows.select(
        "map_id", "p.player_id", "p.player_name", "p.player_url", "map_name", "p.team_name",
        *[f"p.{c}" for c in stats], F.col("inserted_at").alias("last_inserted_at"),
        "last_scraped_at", "last_updated_at", "data_complete", *([F.col("_place").alias(place)] if place else []))


def defaulted_metrics(parsed: DataFrame) -> DataFrame:
    """Warnings: which optional metrics were unreadable and took their default."""
    good = parsed.filter(F.col("error").isNull()).select("map_id", F.explode("players").alias("p"))
    return good.select("map_id", "p.player_id", F.explode("p.defaulted").alias("metric"))


def rejected_pages(parsed: DataFrame, url: str) -> DataFrame:
    return parsed.filter(F.col("error").isNotNull()).select(F.col(url).alias("url"), "error")
