import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchloom import schemas
from matchloom.operators import markup as k
from matchloom.operators import pages as pg
from matchloom.streaming import ingest

NOW = F.expr("timestamp_ntz'2025-01-01 00:00:00'")
TITLES = ["Op. K-D", "MKs", "KAST", "1vsX", "K (hs)", "A (f)", "D (t)", "ADR", "Swing", "Rating 3.0"]


def cells(**over):
    shown = dict(opkd="7 : 4", mks="2", kast="62.5%", clutches="1", kills="31 (17)", assists="8 (3)", deaths="22 (5)",
                 adr="88.6", roundSwing="+6.25%", rating="1.37")
    return {**shown, **over}


def table(team, *player_rows, classes="stats-table totalstats", link='<a href="/player/{0}/p">P{0}</a>'):
    head = f'<th class="st-teamname">{team}</th>' if team else "<th>?</th>"
    body = "".join(
        f'<tr><td class="st-player">{link.format(n)}</td>' + "".join(f'<td class="st-{c}">{v}</td>' for c, v in cs.items()) + "</tr>"
        for n, cs in player_rows)
    return (f'<table class="{classes}"><thead><tr>{head}' + "".join(f"<th>{x}</th>" for x in TITLES)
            + f"</tr></thead><tbody>{body}</tbody></table>")


def map_page(*tables, date='<div class="date">2024-11-17 19:05</div>', name="Anubis", scores=(17, 19), extra=""):
    return (f'<html><body><div class="match-info-box">{date}<div class="small-text">Map</div>\n {name}\n'
            f'<a href="/team/1/a">Alpha</a><div>{scores[0]}</div><a href="/team/2/b">Beta</a><div>{scores[1]}</div>'
            f"<div>Breakdown</div></div>{extra}{''.join(tables)}</body></html>")


def both(**over):
    return table("Alpha", (41, cells(**over))), table("Beta", (42, cells(kills="12 (6)")))


def parse(spark, html, map_id=3307, match_id=880, order=1, url="/stats/matches/mapstatsid/3307/x"):
    pages = spark.createDataFrame([(url, html, map_id, match_id, order)],
                                  "url string, html string, map_id long, match_id long, map_order long")
    return pg.parse_map_pages(pages, NOW)


def error(spark, html, **kw):
    return parse(spark, html, **kw).first()["error"]


def test_map_page(spark):
    parsed = parse(spark, map_page(*both()))
    row = pg.map_rows(parsed).first()
    assert (row.map_id, row.match_id, row.map_order, row.map_name) == (3307, 880, 1, "Anubis")
    assert (row.team1_score, row.team2_score, row.map_winner) == (17, 19, "Beta")
    assert row.date == dt.datetime(2024, 11, 17, 19, 5)
    first, second = sorted(pg.player_rows(parsed).collect(), key=lambda r: r.player_id)
    assert (first.kills, first.headshots, first.assists, first.flash_assists, first.deaths, first.traded_deaths) == (31, 17, 8, 3, 22, 5)
    assert (first.opening_kills, first.opening_deaths, first.kd_diff, first.fk_diff) == (7, 4, 9, 3)
    assert (first.kast, first.adr, first.round_swing, first.rating) == (0.625, 88.6, 0.0625, 1.37)
    assert (first.player_id, first.player_name, first.team_name) == (41, "P41", "Alpha")
    assert (second.team_name, second.kills) == ("Beta", 12)
    assert [f.name for f in pg.player_rows(parsed).schema] == schemas.PLAYERS.names


def test_visible_cell_beats_hidden_and_position(spark):
    hidden = ('<td class="st-kills eco-adjusted-data hidden">45 (30)</td><td class="st-kills traditional-data">31 (17)</td>'
              '<td class="st-adr eco-adjusted-data">131.4</td>')
    page = map_page(*both()).replace('<td class="st-kills">31 (17)</td>', hidden).replace('<td class="st-adr">88.6</td>', "", 1)
    row = min(pg.player_rows(parse(spark, page)).collect(), key=lambda r: r.player_id)
    assert (row.kills, row.headshots, row.adr) == (31, 17, 131.4)


def test_header_names_place_unclassed_cells(spark):
    page = map_page(*both()).replace('class="st-rating"', "").replace('class="st-mks"', "")
    row = min(pg.player_rows(parse(spark, page)).collect(), key=lambda r: r.player_id)
    assert (row.rating, row.multi_kills) == (1.37, 2)


@pytest.mark.parametrize("over, message", [
    ({"kills": ""}, "kills missing"), ({"kills": "-"}, "kills unreadable"), ({"assists": ""}, "assists missing"),
    ({"assists": "-"}, "assists unreadable"), ({"deaths": ""}, "deaths missing"), ({"kast": "N/A"}, "kast unreadable"),
    ({"adr": "N/A"}, "adr unreadable"), ({"rating": "N/A"}, "rating unreadable")])
def test_required_metrics(spark, over, message):
    parsed = parse(spark, map_page(*both(**over)))
    assert parsed.first()["error"] == message
    assert pg.player_rows(parsed).count() == 0 and pg.rejected_pages(parsed, "map_url").count() == 1


def test_optional_metrics_default_with_a_warning(spark, rows):
    parsed = parse(spark, map_page(*both(roundSwing="n/a", opkd="", mks="x")))
    row = min(pg.player_rows(parsed).collect(), key=lambda r: r.player_id)
    assert (row.round_swing, row.opening_kills, row.multi_kills) == (0.0, 0, 0)
    assert rows(pg.defaulted_metrics(parsed), "player_id", "metric") == [
        (41, "multi-kills"), (41, "opening duels"), (41, "round swing")]


@pytest.mark.parametrize("link, message", [
    ("", "player name missing"), ("Solo", "player url missing"), ('<a href="/player/no-id">X</a>', "player id missing")])
def test_player_identity(spark, link, message):
    page = map_page(table("Alpha", (1, cells()), link=link), table("Beta", (2, cells())))
    assert error(spark, page) == message


def test_page_level_errors(spark):
    assert error(spark, "<html><body></body></html>") == "map name missing"
    assert error(spark, map_page()) == "no player tables"
    assert error(spark, map_page(both()[0])) == "map teams missing"
    assert error(spark, map_page(*both()).replace("<div>19</div>", "")) == "map scores unreadable"
    assert error(spark, map_page(*both()), match_id=None) == "no parent match id"
    assert error(spark, map_page(*both()), order=None) == "map order unknown"
    assert error(spark, map_page(*both(), date="")) == "map date unreadable"
    assert error(spark, map_page(*both(), date='<div class="date" data-unix="soon">2025-08-05</div>')) == "map date unreadable"


def test_order_and_date_fallbacks(spark):
    links = '<a href="/stats/matches/mapstatsid/7/x"></a><a href="/stats/matches/mapstatsid/7/y"></a><a href="/stats/matches/mapstatsid/3307/x"></a>'
    row = parse(spark, map_page(*both(), extra=links, date='<div class="date" data-unix="1704067261500"></div>'), order=0).first()
    assert (row.error, row.map_order, row.date) == (None, 2, dt.datetime(2024, 1, 1, 0, 1, 1))


def test_text_of_cells_in_place_and_below(spark):
    """A lone text is looked up; blanks, further elements and missing nodes read as before. Each header is named once."""
    nodes = F.col("nodes")
    page = "<p> a </p><p> </p><p></p><p><b></b></p><p><b>c</b></p><p>d<i>e</i> f </p>"
    rows = pg.outlined(spark.createDataFrame([(page,)], "html string"))
    got = rows.select(F.transform(k.select(nodes, "p"), lambda p: k.text_of(nodes, p, " ")).alias("texts"),
                      k.text_of(nodes, k.first(k.select(nodes, "q"))).alias("none")).first()
    assert got["texts"] == ["a", "", "", "", "c", "d e f"] and got["none"] == ""
    plan = rows.select(pg._section(nodes).alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[^a-z0-9.]") == 1


def test_hidden_and_plain_tables(spark):
    shadow = table("Gamma", (9, cells()), classes="stats-table totalstats hidden")
    assert pg.player_rows(parse(spark, map_page(shadow, *both()))).count() == 2
    plain = [t.replace(" totalstats", "") for t in both()]
    assert pg.player_rows(parse(spark, map_page(*plain))).count() == 2
    nameless = table(None, (9, cells()))
    teams = {r.team_name for r in pg.player_rows(parse(spark, map_page(*both(), nameless))).collect()}
    assert teams == {"Alpha", "Beta", "Unknown"}


MATCH = ('<div class="teamName">One</div><div class="teamName">Two</div>'
         '<div class="team1-gradient"><a href="/team/1/x">One</a><div>16</div></div>'
         '<div class="team2-gradient"><a href="/team/2/y">Two</a><div>10</div></div>'
         '<div class="event text-ellipsis">Cup</div><div class="padding preformatted-text">Best of 3\n1</div>'
         '<div class="mapname">Inferno</div><div class="date" data-unix="1704067200000"></div>'
         '<a class="results-stats" href="/stats/matches/mapstatsid/2/m"></a>'
         '<a class="stream-box" data-demo-link="/download/demo/77"></a><a class="stream-box" data-demo-link="/download/demo/78"></a>')


def match_row(spark, html, url="/matches/77012/a-vs-b"):
    return pg.parse_match_pages(spark.createDataFrame([(url, html)], "url string, html string"), NOW).first()


def test_match_page(spark):
    row = match_row(spark, MATCH)
    assert (row.error, row.match_id, row.team1, row.team2, row.score1, row.score2, row.winner) == (
        None, 77012, "One", "Two", 16, 10, "One")
    assert (row.event, row.match_type, row.forfeit, row.date) == ("Cup", "bo3", False, dt.datetime(2024, 1, 1))
    assert [(m.map_id, m.map_url) for m in row.map_links] == [(2, pg.SITE + "/stats/matches/mapstatsid/2/m")]
    assert [(m.demo_id, m.demo_url) for m in row.demo_links] == [("77", pg.SITE + "/download/demo/77")]


@pytest.mark.parametrize("cut, message", [
    ('<div class="teamName">Two</div>', "team names missing"), ("<div>10</div>", "team scores unreadable"),
    ('<div class="event text-ellipsis">Cup</div>', "event name missing"),
    ('<div class="padding preformatted-text">Best of 3\n1</div>', "match type unreadable"),
    ('<div class="mapname">Inferno</div>', "forfeit status missing"),
    ('<div class="date" data-unix="1704067200000"></div>', "match date unreadable")])
def test_match_page_errors(spark, cut, message):
    assert match_row(spark, MATCH.replace(cut, "")).error == message


def test_match_page_value_errors(spark):
    assert match_row(spark, MATCH.replace("1704067200000", "9" * 21)).error == "match date unreadable"
    assert match_row(spark, MATCH, url="/match/x").error == "no match id in url"
    assert match_row(spark, MATCH.replace("/stats/matches/mapstatsid/2/m", "/stats/none")).error == "map link without id"


def test_results_pages(spark, rows):
    def section(head, *hrefs):
        links = "".join(f'<div class="result-con"><a href="{h}"></a></div>' for h in hrefs)
        return f'<div class="results-sublist"><div class="standard-headline">Results for {head}</div>{links}</div>'
    pages = spark.createDataFrame([
        (0, section("not-a-date", "/matches/111/a") + section("August 5th 2025", "/matches/222/a", "/results/none", "/matches/223/a")
         + '<div class="results-sublist"></div>'),
        (1, section("May 5th 2024", "/matches/333/a") + section("July 1st 2025", "/matches/444/a"))], "page_id long, html string")
    start, end = F.lit("2025-01-01").cast("date"), F.lit("2025-12-31").cast("date")
    assert rows(pg.discover_links(pages, start, end), "match_id") == [(222,), (223,), (444,)]
    assert rows(pg.discover_links(pages, start, end, limit=2), "match_id") == [(222,), (223,)]
    assert pg.result_links(pages).filter("match_date is null").count() == 1


def test_triage(spark, rows):
    pages = spark.createDataFrame([
        (1, "u", '<div class="match-info-box">captcha</div>'), (2, "u", "<title>Just a moment...</title>"), (3, "u", None)],
        "page_id long, url string, html string")
    assert rows(pg.triage(pages), "page_id", "status", "retryable") == [
        (1, "ok", False), (2, "blocked", True), (3, "missing_content", True)]


def test_outline_handles_loose_markup(spark):
    html = "<p><b>one<br>two<p>three &amp; four</b><script>var x='</p>'</script><img src=a><!-- gone --></div></p>"
    nodes = F.col("nodes")
    df = spark.createDataFrame([(html,)], "html string").select(k.outline("html").alias("nodes"))
    row = df.select(F.array_join(k.strings(nodes), "|").alias("all"),
                    k.text_of(nodes, k.first(k.select(nodes, "b")), " ").alias("b"),
                    k.text_of(nodes, k.first(k.select(nodes, "table"))).alias("none")).first()
    assert tuple(row) == ("one|two|three & four", "one two three & four", "")


def test_map_pages_land_together(spark, rows, tmp_path):
    store = ingest.open_store(spark, str(tmp_path / "store"), 4)
    found = spark.createDataFrame([(i, f"/mapstatsid/{i}/x", 880, 1) for i in (1, 2, 3, 4)],
                                  "map_id long, map_url string, match_id long, map_order long")
    ingest.record_discoveries(store, found, 0, "map_state", "map_id", NOW, "match_parser")
    no_rows = map_page(table("Alpha"), table("Beta"))
    pages = spark.createDataFrame([
        (1, 880, 1, "/mapstatsid/1/x", map_page(*both())), (2, 880, 1, "/mapstatsid/2/x", map_page(*both(kast="N/A"))),
        (3, 880, 1, "/mapstatsid/3/x", no_rows), (4, 880, 1, "/mapstatsid/4/x", "<title>Just a moment...</title>")],
        "map_id long, match_id long, map_order long, url string, html string")
    ingest.ingest_map_pages(store, pages, 1, NOW)
    state = rows(store.read("map_state"), "map_id", "status", "failure_count", "last_error_message")
    assert state == [(1, "processed", 0, None), (2, "failed", 1, "kast unreadable"),
                     (3, "failed", 1, "Parsing returned no player records"), (4, "processing", 0, None)]
    assert rows(store.read("maps"), "map_id") == [(1,)] and store.read("players").count() == 2
    ingest.ingest_map_pages(store, pages, 1, NOW)
    assert rows(store.read("map_state"), "map_id", "status", "failure_count", "last_error_message") == state


def test_tries_of_one_map_leave_one_outcome(spark, rows, tmp_path):
    store = ingest.open_store(spark, str(tmp_path / "store"), 4)
    found = spark.createDataFrame([(i, f"/mapstatsid/{i}/x", 7, 1) for i in (1, 2, 3)], "map_id long, map_url string, match_id long, map_order long")
    ingest.record_discoveries(store, found, 0, "map_state", "map_id", NOW, "match_parser")
    good, blocked = map_page(*both()), "<title>Just a moment...</title>"
    pages = spark.createDataFrame(
        [(1, 7, 1, "/mapstatsid/1/x", html, n) for n, html in enumerate([blocked, blocked, good])]
        + [(2, 7, 1, "/mapstatsid/2/x", blocked, n) for n in range(3)]
        + [(3, 7, 1, "/mapstatsid/3/x", html, n) for n, html in enumerate([good, good])],
        "map_id long, match_id long, map_order long, url string, html string, fetch_order int")
    ingest.ingest_map_pages(store, pages, 0, NOW)
    assert rows(store.read("map_state"), "map_id", "status", "failure_count", "last_error_message") == [
        (1, "processed", 0, None), (2, "failed", 1, "page blocked"), (3, "processed", 0, None)]
    assert rows(store.read("maps"), "map_id") == [(1,), (3,)] and store.read("players").count() == 4
