import gzip
import hashlib
import io
import json
import time
import zlib
from pathlib import Path

import duckdb
import pytest
from compare import connect, differences
from llm_helpers import run  # noqa: F401
from pyspark.sql import functions as F

from tidemark.llm import html_text, oracles, queries, warc
from tidemark.llm.common import stored
from tidemark.llm.html_text import Page

LONG = "<p>" + "é" * 80 + "</p>"
PAGES = [(1, "http://a.x/1", LONG), (2, "http://a.x/2", LONG), (3, None, None), (4, "http://a.x/4", ""), (5, "http://a.x/5", "short"),
         (6, "http://a.x/6", "short"), (None, "http://a.x/7", LONG), (1, "http://a.x/1", LONG), (8, "x y\r\nz", LONG + "<i>own</i>\r\n\r\n")]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_queries_match_sql(spark, sf_dir, name):
    assert differences(queries.queries()[name](spark, sf_dir), connect(sf_dir), oracles.oracle_sql()[name]) == []
    assert duckdb.__version__


def test_round_trip_through_archives(spark, pages, tmp_path):
    got = sorted(map(tuple, warc.round_trip(spark, pages.repartition(2), str(tmp_path / "w")).collect()), key=str)
    want = []
    for i, _, text in PAGES:
        raw = (text or "").encode()
        again = text == LONG and i != 1
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 1 if again else None))
    assert got == sorted(want, key=str)
    # the normaliser's files: one gzip member per record, where the sidecar says
    n = 0
    for side in Path(tmp_path / "w" / "members").glob("*.idx"):
        data = Path(str(side)[:-4]).read_bytes()
        for line in side.read_text().splitlines():
            offset, size = json.loads(line)
            inflater = zlib.decompressobj(31)
            assert inflater.decompress(data[offset:offset + size]).startswith(b"WARC/1.1\r\n")
            assert inflater.eof and not inflater.unused_data
            n += 1
    assert n == len(PAGES)
    raw = [gzip.decompress(f.read_bytes()) for f in Path(tmp_path / "w" / "raw").glob("part-*")]
    assert sum(r.count(b"WARC/1.1\r\n") for r in raw) == n
    assert not list((tmp_path / "w").rglob(".part*"))


def test_archives_rotate_and_payloads_come_back(spark, pages, tmp_path):
    folder = str(tmp_path / "w")
    rows = warc.with_verdict(pages.coalesce(1))
    made = warc.write_archives(rows, folder, archive_bytes=1200).persist()
    assert made.count() > 2 and made.groupBy().sum("records").first()[0] == len(PAGES)
    members = warc.normalise(made, folder, folder + "/m").persist()
    back = warc.read_archives(members, folder + "/m", range_records=1).collect()
    assert {r.payload.decode() for r in back if r.record_type == "response"} == {t or "" for i, _, t in PAGES if i != 2}
    assert {r.url for r in back} == {"http://a.x/1", "http://a.x/2", None, "http://a.x/4", "http://a.x/5", "http://a.x/6",
                                     "http://a.x/7", "x%20y%0D%0Az"}


def test_every_archive_and_range_has_a_task(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"http://a.x/{i}", f"<p>{i}</p>", 7, "x") for i in range(90)], "page_id long, url string, html string, digest int, archive string")
    folder = str(tmp_path / "w")
    made = stored(warc.write_archives(warc.with_verdict(rows.repartition(9)), folder), "archives")
    assert made.count() == 9
    normalised = warc.normalise(made, folder, f"{folder}/m")
    assert normalised.withColumn("task", F.spark_partition_id()).select("task").distinct().count() == 9
    back = warc.read_archives(normalised.persist(), f"{folder}/m", range_records=5)
    assert back.withColumn("task", F.spark_partition_id()).select("task").distinct().count() == sum(
        -(-r.records // 5) for r in made.collect())
    assert {(r.page_id, r.payload.decode()) for r in back.collect()} == {(str(i), f"<p>{i}</p>") for i in range(90)}


def test_no_pages(spark, pages, tmp_path):
    assert warc.round_trip(spark, pages.where("page_id > 1000"), str(tmp_path / "w")).collect() == []


def test_schemes_of_hadoop_connectors():
    assert [warc.arrow_uri(f"{s}://bucket/x y") for s in ("s3a", "S3N", "s3", "hdfs", "wasbs", "abfss", "viewfs")] == [
        f"{s}://bucket/x y" for s in ("s3", "s3", "s3", "hdfs", "abfss", "abfss", "viewfs")]
    assert warc.arrow_uri("/plain/folder") == "/plain/folder"
    assert warc.file_system("file:///tmp/a%20b")[1] == warc.file_system("file:/tmp/a%20b")[1] == "/tmp/a b"
    with pytest.raises(ValueError):
        warc.file_system("nosuch://bucket/x")


def test_records_of_whole_streams_members_and_damage():
    records = [warc.record(i, None, "x" * i, "0", None, "d") for i in (0, 5, 3_000_000)]
    whole, members = gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))
    for data in (whole, members, gzip.compress(b"".join(records[:2])) + members):
        assert list(warc.records_of(io.BytesIO(data).read))[-1] == (records[1] if data is None else records[2])
    assert list(warc.records_of(io.BytesIO(whole).read)) == records
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(gzip.compress(records[1][:-5])).read))
    assert list(warc.records_of(io.BytesIO(b"").read)) == []


def test_structure_decides_first():
    text = lambda h: Page(h).text()
    assert text("<nav>menu</nav><article><h1>T</h1><p>a <b>b</b>\n c&amp;d&nbsp;e<p>f<div class='ad'>x</div><aside>y</aside></article><footer>z") == (
        "T\na b c&d e\nf")
    assert text("<p>one<p>two<ul><li>three<li>four</ul><script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>no -->") == "one\ntwo\nthree\nfour"
    assert text("<main>a<div class='comments'>no</div><form>no</form><p class='x'>b</main>c") == "a\nb"
    assert text("<body class='has-ads'><div role=navigation>n</div><div id=sidebar>s</div>kept") == "kept"
    assert text("plain & simple &lt;tag&gt; a < b") == "plain & simple <tag> a < b"
    assert text("") == "" and text("<p") == "" and text("<article><p>cut &am") == "cut &am"
    assert text("<article><p>x</div>y</article>") == "x\ny"
    assert text("<p title=\"a>b\">quoted</p><p title='unclosed>rest</p>") == "quoted\nrest"
    assert len(text("<p>" + "w " * 200_000)) == 399_999


def test_recurring_subtrees_go_per_host(spark):
    top = "<div><a href=/>Home</a> <span>Welcome to the site</span></div>"
    page = lambda i: f"<html><body>{top}<div><p>Own text number {i}.</p></div><div>Legal line</div></body></html>"
    docs = [(i, f"http://User@One.example:80/{i}", page(i)) for i in range(8)]
    docs += [(100, "http://two.example/", page(100)), (101, None, page(101)), (None, "http://one.example/n", None)]
    # copies of an article repeat on a host too, and stay
    docs += [(200 + i, f"http://three.example/{i}", f"<article><p>The same story</p></article>{top}") for i in range(6)]
    got = {r.page_id: r for r in html_text.extract_text(spark.createDataFrame(docs, "page_id long, url string, html string")).collect()}
    assert all(got[i].text == f"Own text number {i}." and got[i].n_chars == len(got[i].text) for i in range(8))
    assert got[100].text == "Home Welcome to the site\nOwn text number 100.\nLegal line" and got[101].text.startswith("Home")
    assert got[None].text == "" and all(got[200 + i].text == "The same story" for i in range(6))
    empty = html_text.extract_text(spark.createDataFrame([], "page_id long, url string, html string"))
    assert empty.count() == 0


def test_copies_of_a_page_do_not_make_its_text_a_template(spark):
    top = "<div><a href=/>Home</a> <span>Welcome to the site</span></div>"
    body = lambda i: f"<div><h2>Story {i}</h2><p>First part of {i}.</p><p>Second part of {i}.</p></div>"
    story = lambda i: f"Story {i}\nFirst part of {i}.\nSecond part of {i}."
    sources = "<article><p>Text</p><ul>" + "".join(f"<li><a href=/{k}>Source {k}</a></li>" for k in range(5)) + "</ul></article>"
    # nine rows of one page, among them other menus around it, and eleven other pages
    docs = [(i, f"http://one.example/{i}", f"<nav>Day {i}</nav>{top}{body(0)}") for i in range(9)]
    docs += [(i, f"http://one.example/{i}", top + body(i)) for i in range(9, 20)]
    docs += [(100 + i, f"http://two.example/{i}", body(0)) for i in range(6)]
    docs += [(200 + i, f"http://three.example/{i}", sources) for i in range(6)]
    got = {r.page_id: r.text for r in html_text.extract_text(spark.createDataFrame(docs, "page_id long, url string, html string")).collect()}
    assert got == {i: story(0 if i < 9 else i) for i in range(20)} | {100 + i: story(0) for i in range(6)} | {
        200 + i: "Text\n" + "\n".join(f"Source {k}" for k in range(5)) for i in range(6)}


def test_recurring_subtrees_go_per_section_of_a_large_host(spark):
    menu = lambda part: f"<div><a href=/{part}/>All of {part}</a></div>"
    page = lambda i, part: f"<div>Site line</div>{menu(part)}<div><p>Own text number {i}.</p></div><div>Note of {part}</div>"
    docs = [(i, f"http://big.example/s{i % 8}/{i}", page(i, f"s{i % 8}")) for i in range(80)]
    docs += [(100 + i, f"http://big.example/{i}", page(100 + i, "front")) for i in range(3)]
    docs += [(200 + i, f"http://other.example/s{i}/x", page(200 + i, "s1")) for i in range(3)]
    got = {r.page_id: r.text for r in html_text.extract_text(spark.createDataFrame(docs, "page_id long, url string, html string")).collect()}
    assert len(got) == len(docs) and all(got[i] == f"Own text number {i}." for i in range(80))
    assert all(got[100 + i] == f"All of front\nOwn text number {100 + i}.\nNote of front" for i in range(3))
    assert all(got[200 + i].startswith("Site line\nAll of s1\nOwn") for i in range(3))


def extracted(spark, docs):
    frame = spark.createDataFrame([(*d, 1, "x", b"y", 2) for d in docs], "page_id long, url string, html string, n int, host string, row binary, hash long")
    return {r.page_id: r.text for r in html_text.extract_text(frame).collect()}


def test_repetition_takes_furniture_and_leaves_shared_prose(spark):
    menu = "<div><div><a href=/a>News</a> <a href=/b>Sport</a></div><div>Members login</div></div>"
    notice = "<div><p>This site tells you on every page that it keeps a note of your visit.</p></div>"
    quoted = "<div><p>A passage that some articles of this site quote in full, as they may.</p></div>"
    link_box = "<ul><li><a href=/1>First</a></li><li><a href=/2>Second</a></li></ul>"

    def page(i):
        own = f"<div><h1>Headline {i}</h1><p>Paragraph of page {i}.</p>{quoted if i % 3 == 0 else ''}</div>"
        return f"<body>{menu}{own}{notice}<div>All rights reserved {'' if i % 2 else 'here'}</div></body>"

    docs = [(i, f"http://one.example/{i}", page(i)) for i in range(30)]
    # in an explicit article: links and labels go, headings and paragraphs stay however often they occur
    docs += [(100 + i, f"http://two.example/{i}", f"<article><h2>Daily report</h2>{link_box}<div>Advertisement</div><p>Report {i}.</p>"
              f"<p>As always.</p></article>") for i in range(12)]
    got = extracted(spark, docs)
    quote = "\nA passage that some articles of this site quote in full, as they may."
    assert got == {i: f"Headline {i}\nParagraph of page {i}.{quote if i % 3 == 0 else ''}" for i in range(30)} | {
        100 + i: f"Daily report\nReport {i}.\nAs always." for i in range(12)}


def test_furniture_goes_by_number_of_pages_whatever_the_host_holds(spark):
    """Four pages of a large host that share a menu are enough; three are not."""
    docs = [(i, f"http://one.example/{i}", f"<div>Line {i if i >= 7 else 'of four' if i < 4 else 'of three'}</div><p>Own {i}.</p>") for i in range(120)]
    got = extracted(spark, docs)
    assert all(got[i] == f"Own {i}." for i in range(4)) and all(got[i] == f"Line of three\nOwn {i}." for i in range(4, 7))
    assert all(got[i] == f"Line {i}\nOwn {i}." for i in range(7, 120))


@pytest.mark.parametrize("source", [
    "<div>" * 200_000, "<p>" * 200_000, "<ul><li>" * 100_000, "<article><p>" + "<span>" * 100_000 + "</p>" * 100_000,
    "<span>" * 100_000 + "</p>" * 100_000, "<b>x</i>" * 100_000, "<p title='" * 100_000])
def test_deep_and_long_pages_take_linear_time(source):
    start = time.process_time()
    page = Page(source)
    page.text(frozenset(h for h, _ in page.candidates().values()))
    assert page.identity() and time.process_time() - start < 20


def test_given_pages(run, spark, sf_dir):  # noqa: F811
    import html
    import re

    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = run("op10_html_extraction").collect()
    assert len(got) == len(source)
    for r in got:
        article = re.search(r"<article>(.*?)(</article>|$)", source[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>?", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)\b[^>]*>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
