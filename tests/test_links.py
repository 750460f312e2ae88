from pyspark.sql import functions as F

from marketflow.functions import markup
from marketflow.operators import filters

PAGE = """<!doctype html><html><head><title><a href="/title">t</a></title><base target=x>
<script>var a = '<a href="/script">';</script><STYLE>a[href="/style"]{}</STYLE></head><body>
<a href="/double">1</a> <a class=x href='/single'>2</a> <A HREF=/bare>3</A> <a
 title='a > b href="/no"' data-href="/no" href = "/spaced?a=1&amp;b=2"  >4</a>
<!-- <a href="/comment">x</a> --> <a href="/num&#46;htm&#x6C;">5</a><a href="  /blanks
/x ">6</a><a href>7</a><a href="">8</a><a name=top>9</a><abbr href="/abbr">10</abbr>
<a href="#top">11</a><a href="mailto:a@b.c">12</a><a href="/file.pdf">13</a><a href="//www.example.com/host">14</a>
<a href="http://other.org/x">15</a><a href="HTTPS://WWW.EXAMPLE.COM/case">16</a><a href="../up">17</a><a href="/two" href="/second">18</a>
<a href="/q'uote">19</a><a href='/d"ouble'>20</a><a href="/a&copy;b&#0;&unknown;">21</a><textarea><a href="/area"></textarea><a/href="/slash">22</a>
<a href="javascript:void(0)">23</a></body></html>"""


def links(spark, html, url="https://www.example.com/dir/page.html?x#y", **more):
    pages = spark.createDataFrame([(1, url, html)], "page_id int, url string, html string")
    return [(r["href"], r["target"]) for r in filters.page_links(pages, **more).collect()]


def test_every_way_to_write_a_link(spark):
    site = "https://www.example.com"
    assert links(spark, PAGE) == [
        ("/double", f"{site}/double"), ("/single", f"{site}/single"), ("/bare", f"{site}/bare"), ("/spaced?a=1&b=2", f"{site}/spaced?a=1&b=2"),
        ("/num.html", f"{site}/num.html"), ("/blanks/x", f"{site}/blanks/x"), ("//www.example.com/host", f"{site}/host"),
        ("HTTPS://WWW.EXAMPLE.COM/case", "HTTPS://WWW.EXAMPLE.COM/case"), ("../up", f"{site}/up"), ("/two", f"{site}/two"),
        ("/q'uote", f"{site}/q'uote"), ('/d"ouble', f'{site}/d"ouble'), ("/a&copy;b&#0;&unknown;", f"{site}/a&copy;b&#0;&unknown;"),
        ("/slash", f"{site}/slash"),
    ]
    assert ("http://other.org/x", "http://other.org/x") in links(spark, PAGE, same_host=False)


def test_base_moves_relative_links(spark):
    html = '<head><base href="/other/"></head><a href="a">1</a><a href="/b">2</a><base href="/late/">'
    assert links(spark, html) == [("a", "https://www.example.com/other/a"), ("/b", "https://www.example.com/b")]


def test_odd_pages(spark):
    assert links(spark, None) == links(spark, "") == links(spark, "<a") == links(spark, "<a href='x") == []
    assert links(spark, "<!-- open <a href='/x'>") == []
    assert links(spark, "<a href=x>" * 3 + "<a " + "b='c' " * 20_000 + "href='/long'>")[-1][0] == "/long"
    assert links(spark, "<a href='/x'>", url="no address") == []


def test_character_references(spark):
    texts = {"&lt;&#65;&#x1F600;&amp;lt;": "<A\U0001f600&lt;", "a&b&;&#xD800;&#99999999;": "a&b&;&#xD800;&#99999999;", "": "", "&nbsp;": " "}
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", markup.decoded_references(F.col("t")).alias("d"))
    assert {r["t"]: r["d"] for r in frame.collect()} == texts
