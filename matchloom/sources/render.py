"""Writes table rows out as pages, so that the page jobs can be checked by a round trip.

Each page comes from one row; no rows are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _join(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _millis(moment: Column) -> Column:
    return F.unix_millis(moment.cast("timestamp"))


def headline(date: Column) -> Column:
    day = F.dayofmonth(date)
    suffix = (F.when(day.isin(1, 21, 31), "st").when(day.isin(2, 22), "nd").when(day.isin(3, 23), "rd").otherwise("th"))
    return _join("Results for ", F.date_format(date, "MMMM d"), suffix, " ", F.year(date))


def results_pages(matches: DataFrame) -> DataFrame:
    """One results page per match; every thirteenth has an unreadable headline."""
    head = F.when(F.col("match_id") % 13 == 0, "Results for not-a-date").otherwise(headline(F.col("date")))
    html = _join(
        '<html><body><div class="results-sublist"><div class="standard-headline">', head,
        '</div><div class="result-con"><a href="/matches/', F.col("match_id"), '/a-vs-b">a</a></div>'
        '<div class="result-con"><a href="/results/none">b</a></div></div></body></html>')
    return matches.select(F.col("match_id").alias("page_id"), F.lit("/results").alias("url"), html.alias("html"))


def results_listing(matches: DataFrame, days: int = 5, ids: int = 20_000) -> DataFrame:
    """Results pages with several dated sections, newest day first, so that page ids rise as dates fall.

    A page holds the matches of ``days`` days whose ids lie in one run of ``ids`` ids. That is a few dozen links whatever the
    number of matches, because ids are spread over the days. Matches whose id 13 divides stand
    in an undated section at its head, and each section ends with a link that names no match.
    """
    age = F.datediff(F.lit("2030-01-01").cast("date"), F.col("date").cast("date")).cast("bigint")
    page = F.floor(age / days) * 1_000_000 + F.floor(F.col("match_id") / ids)
    undated = F.col("match_id") % 13 == 0
    link = _join('<div class="result-con"><a href="/matches/', F.col("match_id"), '/a-vs-b">a</a></div>')
    sections = matches.filter(F.col("date").isNotNull()).select(
        page.alias("page_id"), F.when(undated, -1).otherwise(age).alias("age"),
        F.when(undated, "Results for not-a-date").otherwise(headline(F.col("date"))).alias("head"), F.struct("match_id", link.alias("link")).alias("m")
    ).groupBy("page_id", "age", "head").agg(F.array_sort(F.collect_list("m")).alias("found"))
    html = _join('<div class="results-sublist"><div class="standard-headline">', F.col("head"), "</div>",
                 F.array_join(F.transform("found", lambda m: m["link"]), ""), '<div class="result-con"><a href="/results/none">b</a></div></div>')
    gathered = sections.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("age", html.alias("html")))).alias("parts"))
    body = F.array_join(F.transform("parts", lambda p: p["html"]), "")
    return gathered.select("page_id", F.lit("/results").alias("url"), _join("<html><body>", body, "</body></html>").alias("html"))


def match_pages(matches: DataFrame) -> DataFrame:
    """One page per match; every seventeenth lacks its event name."""
    best_of = F.when(F.col("match_type") == "bo1", "Best of 1").when(F.col("match_type") == "bo3", "Best of 3").otherwise("Best of 5")
    links = F.array_join(F.transform("map_links", lambda m: F.concat(
        F.lit('<a class="results-stats" href="/stats/matches/mapstatsid/'), m["map_id"].cast("string"), F.lit('/x"></a>'))), "")
    demo = F.when(F.size("demo_links") > 0, _join(
        '<a class="stream-box" data-demo-link="/download/demo/', F.col("match_id"), '/x"></a>')).otherwise("")
    event = F.when(F.col("match_id") % 17 == 0, "").otherwise(F.col("event"))
    html = _join(
        '<html><body><div class="teamName"> ', F.col("team1"), ' </div><div class="teamName">', F.col("team2"),
        '</div><div class="team1-gradient"><a href="/team/1/a">', F.col("team1"), "</a> <div> ", F.col("score1"),
        ' </div></div><div class="team2-gradient"><a href="/team/2/b">', F.col("team2"), "</a><div>", F.col("score2"),
        '</div></div><div class="event text-ellipsis"> ', event,
        '</div><div class="padding preformatted-text">\n ', best_of, '\n * Semifinal 7</div><div class="mapname">',
        F.when(F.col("forfeit"), "Default").otherwise("Inferno"), '</div><div class="date" data-unix="',
        _millis(F.col("date")), '"></div>', links, demo, "</body></html>")
    return matches.select(F.col("match_id").alias("page_id"), F.col("match_url").alias("url"), html.alias("html"))


# Header titles of the stat tables, each with the spellings pages use, and the cell classes.
TITLES = {
    "st-opkd": ["Op. K-D", "Op.K-D"], "st-mks": ["MKs"], "st-kast": ["KAST"], "st-clutches": ["1vsX"], "st-kills": ["K (hs)", "Kills"],
    "st-assists": ["A (f)"], "st-deaths": ["D (t)", "Deaths"], "st-adr": ["ADR"], "st-roundSwing": ["Swing"],
    "st-rating": ["Rating 3.0", "Rating 2.1"],
}
PLAIN, DECOY = "traditional-data", "eco-adjusted-data hidden"


def _player_row() -> Column:
    """One player's table row. By player, some cells are hidden only, some lack their class (in rows with one cell per column,
    where the header tells what they are), and some are unreadable.

    A hidden decoy in front of a visible cell shows the value of a player who did somewhat better.
    """
    style = F.col("player_id") % 4

    def cell(css: str, value: Column, decoy: Column | None = None, classless: bool = False) -> Column:
        shown = _join(f'<td class="{css} {PLAIN}">', value, "</td>")
        if classless:
            shown = F.when(style == 2, _join("<td>", value, "</td>")).otherwise(shown)
        if decoy is None:
            return shown
        return F.when(style == 1, _join(f'<td class="{css} {DECOY}">', value, "</td>")).when(style == 2, shown).otherwise(
            F.concat(_join(f'<td class="{css} {DECOY}">', decoy, "</td>"), shown))

    def pair(main: str, extra: str, more: int = 0) -> Column:
        return _join(F.col(main) + more, " (", F.col(extra) + more, ")")

    def percent(column: str, pattern: str) -> Column:
        return F.format_string(pattern, F.col(column) * 100)

    mks = F.when(F.col("player_id") % 10 == 9, "n/a").otherwise(F.col("multi_kills").cast("string"))
    rating = F.when(F.col("rating").isNull(), "-").otherwise(F.format_string("%.2f", F.col("rating")))
    return _join(
        '<tr><td class="st-player"><a href="/player/', F.col("player_id"), '/p">', F.col("player_name"), "</a></td>",
        cell("st-opkd", _join(F.col("opening_kills"), " : ", F.col("opening_deaths")),
             _join(F.col("opening_kills") + 1, " : ", F.col("opening_deaths") + 2)),
        cell("st-mks", mks, classless=True), cell("st-kast", percent("kast", "%.1f%%"), F.format_string("%.1f%%", F.col("kast") * 100 + 1)),
        cell("st-clutches", F.col("clutches_won")), cell("st-kills", pair("kills", "headshots"), pair("kills", "headshots", 3)),
        cell("st-assists", pair("assists", "flash_assists")), cell("st-deaths", pair("deaths", "traded_deaths"), pair("deaths", "traded_deaths", 5)),
        cell("st-adr", F.format_string("%.1f", F.col("adr")), F.format_string("%.1f", F.col("adr") + 7)),
        cell("st-roundSwing", percent("round_swing", "%+.2f%%")), cell("st-rating", rating), "</tr>")


def map_pages(enriched: DataFrame) -> DataFrame:
    """One page per map: a table for either team, and one for each further team its players name.

    The players of a map are gathered into its page; a map has a handful. A team that is not
    named anywhere heads its table with a question mark. Every seventh map spells its headers the other way.
    """
    heads = F.lit("")
    for spellings in TITLES.values():
        heads = F.concat(heads, F.when(F.col("map_id") % 7 == 0, f"<th>{spellings[-1]}</th>").otherwise(f"<th>{spellings[0]}</th>"))
    described = ["map_id", "match_id", "map_order", "map_name", "map_date", "team1", "team2", "map_team1_score", "map_team2_score"]
    side = F.when(F.col("team_name") == F.col("team1"), 0).when(F.col("team_name") == F.col("team2"), 1).otherwise(2)
    players = enriched.select(*described, F.struct(
        side.alias("side"), F.coalesce("team_name", F.lit("")).alias("team"), "player_id", _player_row().alias("row")).alias("p"))
    gathered = players.groupBy(*described).agg(F.array_sort(F.collect_list("p")).alias("players"))

    def table(team: Column, rows: Column) -> Column:
        heading = F.when(team == "", "<th>?</th>").otherwise(F.concat(F.lit('<th class="st-teamname">'), team, F.lit("</th>")))
        body = F.array_join(F.transform(rows, lambda p: p["row"]), "")
        return F.concat(F.lit('<table class="stats-table totalstats"><thead><tr>'), heading, heads, F.lit("</tr></thead><tbody>"), body,
                        F.lit("</tbody></table>"))

    def of_side(n: int) -> Column:
        return F.filter("players", lambda p: p["side"] == n)
    others = F.array_sort(F.array_distinct(F.transform(of_side(2), lambda p: p["team"])))
    further = F.array_join(F.transform(others, lambda t: table(t, F.filter(of_side(2), lambda p: p["team"] == t))), "")
    html = _join(
        '<html><body><div class="match-info-box"><div class="date">', F.date_format("map_date", "yyyy-MM-dd HH:mm"),
        '</div><div class="small-text">Map</div> ', F.col("map_name"), ' <a href="/team/1/a">', F.col("team1"),
        "</a><div>", F.col("map_team1_score"), '</div><a href="/team/2/b">', F.col("team2"), "</a><div>",
        F.col("map_team2_score"), "</div><div>Breakdown</div></div>",
        table(F.col("team1"), of_side(0)), table(F.col("team2"), of_side(1)), further, "</body></html>")
    url = _join("https://example.test/stats/matches/mapstatsid/", F.col("map_id"), "/x")
    return gathered.select(url.alias("url"), html.alias("html"), "map_id", "match_id", "map_order")
