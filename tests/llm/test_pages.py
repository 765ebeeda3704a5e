"""WARC archives with their index, and main texts of pages."""

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchloom.llm import op1_warc as warc
from matchloom.llm import op3_templates as templates
from matchloom.session import shared_path

PAGES = "page_id long, url string, html string, time long, n int, hash long"


def captures(spark, n=60):
    rng = random.Random(7)
    same = "<p>" + "é" * 60
    rows = [(i, f"http://{'abc'[i % 3]}.example.org/{i % 4}?q=A", rng.choice([same, "short", None, "", f"<p>{'x' * 200}{i}\r\n\r\n"]), rng.choice([5, 9, None, i]), 1, 2) for i in range(n)]
    rows += [rows[3], (None, None, same, 1, 0, 0), (n, "http://[bad", "z" * 300, 2, 0, 0), (n + 1, "x\r\ny", "z" * 300, 2, 0, 0)]
    return spark.createDataFrame(rows, PAGES)


def test_archives_come_back(spark):
    pages = captures(spark)
    got = warc.capture_history(pages).collect()
    rows = pages.collect()
    first = {}
    for r in rows:
        data = (r["html"] or "").encode()
        if len(data) >= 100 and r["page_id"] is not None:
            first[data] = min(first.get(data, r["page_id"]), r["page_id"])
    want = []
    for r in rows:
        data = (r["html"] or "").encode()
        refers = first[data] if data in first and first[data] != r["page_id"] else None
        want.append((r["page_id"], len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", refers, r["time"] or 0))
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["time"]) for r in got), key=repr) == sorted(want, key=repr)
    order = [(r["url_key"], r["time"], -1 if r["page_id"] is None else r["page_id"]) for r in sorted(got, key=lambda r: (r["part"], r["place"]))]
    assert order == sorted(order)
    assert warc.capture_history(pages.limit(0)).count() == 0


def test_merge_in_levels_and_many_ranges(spark):
    pages = captures(spark, 200).repartition(9)
    folder = shared_path(spark, "levels")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        archives = warc.write_archives(pages, f"{folder}/archives")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    runs = warc.read_runs(archives, f"{folder}/archives", f"{folder}/runs")
    assert runs.count() == archives.count() >= 2
    got = warc.merge_runs(runs, f"{folder}/runs", fan_in=2, range_rows=20).collect()
    order = [(r["url_key"], r["time"], -1 if r["page_id"] is None else r["page_id"]) for r in sorted(got, key=lambda r: (r["part"], r["place"]))]
    assert len(got) == 204 and order == sorted(order) and len({r["part"] for r in got}) > 5


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9)), max_size=9))
def test_loser_tree(sources):
    sorted_sources = [iter([((x,), {"v": x}) for x in sorted(s)]) for s in sources]
    assert [r["v"] for r in warc.LoserTree(sorted_sources)] == sorted(x for s in sources for x in s)


def test_records_and_keys():
    data = warc.record(4, "http://WWW.Example.org/A?b", 3, b"a\r\n\r\nb", hashlib.sha256(b"a\r\n\r\nb").hexdigest(), None, False)
    assert warc.parsed(data)[1] == b"a\r\n\r\nb" and warc.capture(data, "x", 0, 1)["url_key"] == "org,example)/a?b"


def page(i, article, nav="<ul><li><a href='/a'>Home</a></li><li>About us</li></ul>", extra=""):
    return (
        f"<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var t='</p><p>no';</script></head><body><header>Site</header><nav>{nav}</nav>"
        f"<div class='box'>Follow our channel today</div>{article}{extra}<footer>&copy; site</footer></body></html>"
    )


def test_main_texts(spark):
    common = "<p>Every article ends with this line.</p>"
    rows = [(i, f"https://a.org/{i}", page(i, f"<article><header><h1>Title &amp; {i}</h1></header><p><b>Lead {i}.<br><p>Body\n  {i}&nbsp;text&hellip;</p>{common}<div class='comments'><article>Nice!</article></div></article>")) for i in range(6)]
    rows += [(i, f"https://b.org/{i}", page(i, f"<div><p>Only a body {i}.</p><p>And more {i}</p></div>")) for i in range(10, 16)]
    copied = page(0, "<article><p>Served at many addresses.</p></article>")
    rows += [(i, f"https://c.org/{i}", copied) for i in range(20, 30)]
    rows += [(40, None, "<p>loose <i>text</i> &lt;x&gt;<!-- no --> <script>x"), (41, "u", None), (42, "u", ""), (43, "u", "<ul><li>one<li>two</ul><table><tr><td>a<td>b</table>"), (44, "u", "plain & simple")]
    rows += [(45, "u", "<div>" * 3000 + "deep" + "</div>" * 10), (46, "u", "<p hidden>no</p><div role=navigation>no</div><p>yes</p><form>no<p>no</form>"), (47, "u", "<a href=\"x>y\">z</a> <a href='unclosed>w")]
    rows += [rows[0], (None, "https://a.org/x", rows[1][2])]
    pages = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], PAGES)
    found = templates.main_texts(pages).collect()
    got = {r["page_id"]: r["text"] for r in found}
    assert len(found) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in found)
    for i in range(6):
        assert got[i] == f"Title & {i}\nLead {i}.\nBody {i} text…\nEvery article ends with this line."
    for i in range(10, 16):
        assert got[i] == f"Only a body {i}.\nAnd more {i}"  # the box recurs on the host and goes
    assert all(got[i] == "Served at many addresses." for i in range(20, 30))
    assert got[40] == "loose text <x>" and got[41] == got[42] == "" and got[43] == "one\ntwo\na\nb" and got[44] == "plain & simple" and got[45] == "deep" and got[46] == "yes"
    assert templates.main_texts(pages.limit(0)).count() == 0


def test_boxes_that_rotate_on_a_large_host(spark):
    line = "<p>By our own staff.</p>"
    rows = [(i, f"https://e.org/{i}", page(i, f"<div><h1>Title {i}</h1><p>The only body of page {i}.</p>{line if i % 40 == 0 else ''}</div>", extra=f"<div>Advert {i % 30}: buy</div>"), 0, 0, 0) for i in range(3000)]
    copied = "<div><p>Served at many addresses, a text longer than its boxes.</p></div>"
    rows += [(i, f"https://e.org/{i}", page(0, copied, extra=f"<div>Advert {i % 30}: buy</div>"), 0, 0, 0) for i in range(3000, 3100)]
    got = {r["page_id"]: r["text"] for r in templates.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    for i in range(3000):
        said = [f"Title {i}", f"The only body of page {i}.", *(["By our own staff."] if i % 40 == 0 else [])]
        assert got[i] == "\n".join(said)
    assert {got[i] for i in range(3000, 3100)} == {"Served at many addresses, a text longer than its boxes."}


def test_a_class_takes_no_article_away():
    for said in ("content has-sidebar", "no-sidebar page", "single-post sidebar-right", "post comments-open", "search-results", "menu"):
        for html in (f"<div class='{said}'><article><p>Kept</p></article></div>", f"<article id=x class='{said}'><p>Kept</p></article>", f"<div class='{said}'><main>Kept</main></div>"):
            assert templates.Page(html).text() == "Kept", html
    for said in ("content has-sidebar", "no-sidebar page", "single-post sidebar-right", "post comments-open", "search-results"):
        assert templates.Page(f"<div class='{said}'><p>Kept</p></div>").text() == "Kept"
    for said in ("ad", "box advertisement", "COMMENTS", "side-bar left"):
        assert templates.Page(f"<article><p>Kept</p><div class='{said}'>no<article>no</article></div></article>").text() == "Kept"
        assert templates.Page(f"<p>Kept</p><div class='{said}'>no</div>").text() == "Kept"


def test_a_host_of_two_pages_has_no_template(spark):
    rows = [(i, "https://d.org/", f"<div><div>Same block</div><p>Text {i}</p></div>", 0, 0, 0) for i in range(2)]
    got = templates.main_texts(spark.createDataFrame(rows, PAGES)).where(F.col("n_removed") > 0)
    assert got.count() == 0


def test_an_article_keeps_what_recurs_in_it(spark):
    same = "<ul><li>Preheat the oven</li><li>Wait</li></ul><div>Same method as before.</div>"
    rows = [(i, f"https://r.org/{i}", page(i, f"<article><h1>Cake {i}</h1><p>Take {i} eggs.</p>{same}<div class='ad'>Buy</div></article>"), 0, 0, 0) for i in range(4)]
    got = {r["page_id"]: r["text"] for r in templates.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: f"Cake {i}\nTake {i} eggs.\nPreheat the oven\nWait\nSame method as before." for i in range(4)}


def test_a_class_or_form_leaves_most_of_a_page():
    for html in (
        "<div class='post social'><p>Body text</p></div>", "<div id='search'><p>Body text</p></div>", "<div class='notice'>Body text</div>",
        "<form><div><p>Body text</p><script>no</script></div></form>", "<body><div role=form><form><p>Body text</p></form></div>",
        "<article><div class='social'><p>Body text</p></div></article>",
    ):
        assert templates.main_text(html) == "Body text", html
    long = "<p>A reader's remark, longer than the text.</p>" * 5
    assert templates.main_text(f"<p>Short</p><div class='comments'>{long}</div>") == "Short"
    assert templates.main_text(f"<article><p>Short</p><section id=comments>{long}</section></article>") == "Short"
    assert templates.main_text("<p>The text</p><div class=social>share</div><form>mail</form>") == "The text"


def test_both_ways_to_delete_templates(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    told = sorted((tuple(r) for r in templates.main_texts(pages).collect()), key=repr)
    monkeypatch.setattr(templates, "TOLD", 0)
    assert sorted((tuple(r) for r in templates.main_texts(pages).collect()), key=repr) == told


def test_open_elements_are_not_searched_in_vain():
    import time

    begun = time.process_time()
    for html in ("<i>" * 30000 + "<hr>" * 30000 + "x", "<i>" * 30000 + "</b>" * 30000 + "x"):
        assert templates.Page(html).text() == "x"
    assert time.process_time() - begun < 10
