"""Elements, selectors and block locators on pages in odd markup."""

import random
import re
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelhouse.sources import elements as module
from reelhouse.sources import pages
from reelhouse.sources.elements import BlockLocator, Selector, cut_pages, elements, located_links, tags

URL = "https://t.example/a"


def paged(spark, *markup):
    return spark.createDataFrame([(f"p{i}", m) for i, m in enumerate(markup)], "page string, html string")


def test_ends_of_nested_unclosed_and_void_elements(spark):
    html = "<div id=a>1<div id=b>2<br><p id=c>3</div>4<img id=d>5</div>6<DIV id='e'>7"
    read = elements(paged(spark, html, html, "", None), lambda tag: F.contains(tag, F.lit("id=")))
    assert sorted((r.page, r.at, r.text) for r in read.collect()) == [
        (p, at, text) for p in ("p0", "p1") for at, text in ((0, "12345"), (1, "23"), (3, "3"), (5, "5"), (7, "7"))
    ]
    depths = tags(cut_pages(paged(spark, html))).where("name = 'div'").orderBy("at").collect()
    assert [(r.at, r.closing, r.depth) for r in depths] == [(0, False, 1), (1, False, 2), (4, True, 2), (6, True, 1), (7, False, 1)]


def test_repeated_pages_count_once(spark):
    page = spark.createDataFrame([("u", "<b id=x>1</b>")] * 3 + [("u", "<b id=x>2</b>"), ("v", "<b id=x>1</b>")], "page string, html string")
    read = elements(page, lambda tag: F.contains(tag, F.lit("id=")))
    assert sorted((r.page, r.text) for r in read.collect()) == [("u", "1"), ("u", "2"), ("v", "1")]


def located(html: str, start: int, anchors, marker, expand, behind, ahead):
    """Plain restatement over characters."""
    before = [html.rfind(a, 0, start) for a in anchors]
    place = max(before) if before and max(before) >= 0 else html.rfind(marker, 0, start)
    place = place if place >= 0 else max(0, start - behind)
    table, table_end = html.rfind("<table", 0, place + 1), html.find("</table>", place)
    if expand == "row":
        first = html.rfind("<tr", 0, place + 1)
        first = first if first >= 0 else max(table, 0)
        end = html.find("</tr>", place)
        return html[first : end + 5 if end >= 0 else table_end + 8 if table_end >= 0 else place + ahead]
    return html[table if table >= 0 else max(0, place - behind) : table_end + 8 if table_end >= 0 else place + ahead]


@pytest.mark.parametrize("expand", ["row", "table"])
def test_blocks_equal_the_plain_restatement(spark, expand):
    style, mark = "<td style='margin:1'>", "<td id=m>"
    link = "<a href='k'>go</a>"
    bodies = [
        f"<table><tr>{style}A</td></tr></table>{link}",
        f"<table><tr>{style}A<table><tr><td>in</td></tr></table></td></tr><tr>{mark}B</tr></table>x{link}y{link}",
        f"<table><tr>{mark}A</td></tr></table>{link}<table><tr>{style}B</tr></table>{link}",
        f"no anchor {link} at all {link}",
        f"{'x' * 30}<table><tr><td>old</td></tr></table>{'y' * 10}{link}",
        f"<tr>{style}A{link}{'z' * 60}",
        f"{style}A{link}</tr>",
        f"<table>{style}A{link}",
        f"{link}<table><tr>{style}late</tr></table>",
        "no link",
    ]
    locator = BlockLocator(("margin:1", "never"), "id=m", expand, look_behind=25, look_ahead=40)
    # the marker's place is its tag
    want = {(f"p{i}", b[s : b.index("</a>", s) + 4], located(b, s, locator.anchors, "<td id=m", expand, 25, 40)) for i, b in enumerate(bodies) for s in range(len(b)) if b.startswith("<a ", s)}
    got = located_links(paged(spark, *bodies, None), "^<a href='k'>", locator).collect()
    assert {(r.page, r.link, r.block) for r in got} == want
    assert len(got) == sum(b.count("<a ") for b in bodies)


def test_style_anchor_before_marker_and_rows(spark):
    html = (
        '<table><tr><td style="margin-bottom:-1px">Dune - 19:10</td></tr><tr><td>Autre film 20:00</td></tr></table>'
        '<a href="/Film-achat.awp?P3=11111">Acheter</a><a href="/Film-achat.awp?P3=22222"><b>21h30</b></a>'
        '<table><tr><td id="zrl_1_A8">Oppenheimer 18:00</td></tr></table><a href="/Film-achat.awp?P3=33333">Acheter</a>'
    )
    spec = pages.LinkScheduleSpec(URL, locator=BlockLocator(("margin-bottom:-1px",), r'id="zrl_[0-9]+_(?:A8|A9)"', "row"))
    rows = pages.link_schedule(paged(spark, html), spec).collect()
    # a style anchor anywhere before the link comes before a nearer marker
    assert sorted((r.title, r.time, r.url) for r in rows) == [("Dune", "19:10", URL + "?P3=11111"), ("Dune", "21:30", URL + "?P3=22222")]


def test_selectors(spark):
    assert Selector("k_{row}_N{cell}").pattern == "^k_([0-9]+)_N([0-9]+)$"
    for bad in ("k_{cell}_{row}", "k", "{row}{row}", "{row}_{cell}_{cell}"):
        with pytest.raises(ValueError):
            Selector(bad).pattern
    with pytest.raises(ValueError):
        BlockLocator((), "", "page")


def test_nested_buttons_and_keys_out_of_range(spark):
    html = (
        "<b id=zrl_1_A37>Dune</b><a id=c-1-A5><span class=t><i>19</i>:10</span></a><b id=tzzrl_1_A201>99999</b><b id=tzzrl_1_A1>88888</b>"
        "<b id=tzzrl_1_A200>11111</b><b id=tzzrl_1_A9>1234</b><div id=c-1-A6>20:00</div>"
    )
    read = lambda **profile: [(r.title, r.time, r.key) for r in pages.ticket_rows(paged(spark, html), pages.TicketSpec(URL, **profile)).orderBy("pos").collect()]
    assert read() == [("Dune", "19:10", "11111")]
    assert read(hidden_range=(1, 300)) == [("Dune", "19:10", "88888")]
    assert read(buttons=(Selector("c-{row}-*", tag="DIV"),)) == [("Dune", "20:00", "11111")]
    assert read(rows=("other_{row}",)) == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def restated(html):
    """at, depth and end of every tag: of one name and depth, an end tag closes the tag before it."""
    level, before, depths, ends = {}, {}, {}, {}
    for at, piece in enumerate(re.split("(?=<)", html) if html[0] != "<" else ["<" + p for p in html.split("<")[1:]]):
        tag = re.match("</?([a-zA-Z][a-zA-Z0-9]*)", piece)
        if tag:
            name, shut = tag[1].lower(), piece.startswith("</")
            level[name] = level.get(name, 0) + (0 if shut else 1)
            depths[at] = level[name]
            if shut and (name, level[name]) in before:
                ends[before[name, level[name]]] = at
            before[name, level[name]] = at
            level[name] -= shut
    return [(at, depth, ends.get(at)) for at, depth in depths.items()]


def test_long_pages_stay_one_row(spark):
    """No piece of a page is dealt or sorted, whatever its length, and tags are those of a plain pass."""
    rnd = random.Random(4)
    markup = ["".join(rnd.choice(["<a>", "</a>", "<B id=x>", "</b>", "<div id=y>", "</div>", "text ", "< p", "<br/>"]) for _ in range(n)) + "." for n in (1, 3, 30, 3000)]
    read = tags(cut_pages(paged(spark, *markup, None)).drop("page")).join(cut_pages(paged(spark, *markup)).select("_page", "html"), "_page").collect()
    for html in markup:
        assert sorted((r.at, r.depth, r.end) for r in read if r.html == html) == restated(html)
    ids = lambda tag: F.contains(tag, F.lit("id="))
    locator = BlockLocator(("margin:1",), "id=m", "row")
    for found in (elements(paged(spark, *markup), ids), located_links(paged(spark, *markup), "^<a", locator)):
        found.count()
        assert "Window" not in plan_of(found) and "Join" not in plan_of(found)


def test_nesting_of_many_pages_needs_the_memory_of_a_few():
    """Beside its input and output, the nesting of a batch takes what one run of pages needs, and cutting into runs changes nothing."""
    rnd = random.Random(7)
    heads = ["", "<b", "</b", "<DIV", "</div", "</A"]
    batch = pa.array([None, [], *[[rnd.choice(heads) for _ in range(20_000)] for _ in range(40)]], pa.list_(pa.string()))
    tracemalloc.start()
    got = module._levels(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * 800_000
    assert got.to_pylist() == [x for i in range(len(batch)) for x in module._levels(batch.slice(i, 1)).to_pylist()]
    assert module._ends(batch).to_pylist() == [p and [x["end"] for x in p] for p in got.to_pylist()]
