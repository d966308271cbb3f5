from pyspark.sql import functions as F

from siftwork.functions import html
from siftwork.functions import urls as U
from siftwork.operators import domains
from siftwork.sources import files

PAGE = """<!DOCTYPE html><html><head><title>not shown</title><style>p{}</style></head><body>
 <script>var t = "</p>";</script><!-- <p>no</p> -->
 <h1>Title &amp; more</h1><div><p>First
   paragraph<br>second line with a <a href="x">link</a>.</p>
 <img src="i.png"><p>Next.</p></div>
 <div>block one</div><div>block two</div>
 <ul><li>apples</li><li><p>pears</p></li><li></li></ul></body></html>"""


def test_extract_text(column):
    [text] = column(html.extract_text, [PAGE])
    assert text == (
        "Title & more\n\nFirst paragraph\nsecond line with a link.\n\nNext.\n\nblock one\nblock two\n  • apples\n  • pears"
    )


def test_drop_elements(column):
    page = "<nav><ul><li>menu</li></ul></nav><p>body</p>"
    assert column(html.extract_text, [page]) == ["  • menu\n\nbody"]
    assert column(lambda c: html.extract_text(c, ("nav",)), [page]) == ["body"]


def test_character_references(column):
    import html as standard
    import random

    rng = random.Random(3)
    names = sorted(standard.entities.html5) if hasattr(standard, "entities") else []
    parts = [
        "&amp;", "&lt", "&lt;", "&notit;", "&notin;", "&no;", "&;", "&", "&&", "& amp;", "&#65;", "&#65", "&#x41;", "&#X1f600;", "&#x110000;", "&#xD800;",
        "&#0;", "&#000065;", "&#128;", "&#x9f;", "&#1;", "&#11;", "&#xfffe;", "&#13;", "&#99999999999999999999;", "&#;", "&#x;", "&#xg;", "&amp;lt;",
        "&ampamp;", "&copyright", "&frac12x", "&CounterClockwiseContourIntegral;", "&acE;", "&fjlig;", "&unknownname;", "x", " ", "\n", "é", "&é;", "<b>",
        "&thetasym;", "&yacutes;", "&quot", "&#38;lt;", "&" + "a" * 40 + ";",
    ]
    texts = [*parts, *["".join(rng.choice(parts) for _ in range(12)) for _ in range(200)], *[f"a&{n}b" for n in names[::7]], "", None]
    expected = [t if t is None else standard.unescape(t) for t in texts]
    assert column(html.unescape, texts) == expected


def test_pages_need_no_python(spark):
    plan = spark.createDataFrame([("<p>&eacute;</p>",)], "t string").select(html.extract_text(F.col("t")))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_decode_html(column):
    pages = ["café".encode(), "café".encode("cp1252"), b'<meta charset="gbk">' + "中文".encode("gbk"), b"<meta charset=nonsense>\xe9"]
    assert column(html.decode_html, pages, "binary") == ["café", "café", '<meta charset="gbk">中文', "<meta charset=nonsense>é"]


def test_registered_domain(spark):
    expected = {
        "http://www.example.com/a": "example.com", "https://user:pw@a.b.example.co.uk:8080/x?y": "example.co.uk",
        "http://192.0.2.1/": "", "http://localhost/": "", "": "", "//cdn.example.org/x": "example.org", "http://co.uk/": "",
        "ftp://Sub.Example.NET.": "example.net", None: "", "http://a.shop.co.ke": "shop.co.ke", "http://www.example.com.do/": "example.com.do",
        "http://x.foo.bar.ck": "foo.bar.ck", "http://bar.ck": "", "http://a.www.ck": "www.ck", "http://a.city.kobe.jp": "city.kobe.jp",
        "http://a.b.c.kobe.jp": "b.c.kobe.jp", "http://www.example.nosuchsuffix": "", "http://sub.例子.中国/": "例子.中国",
        "http://sub.a.xn--fiqs8s/": "a.xn--fiqs8s", "http://a@": "", "http://me.github.io": "github.io",
    }
    rows = spark.createDataFrame([(u, "old") for u in expected], "url string, domain string")
    found = domains.with_registered_domain(rows, domains.suffixes(spark))
    assert {r["url"]: r["domain"] for r in found.collect()} == expected
    private = domains.with_registered_domain(rows.where("url like '%github%'"), domains.suffixes(spark, private=True))
    assert private.first()["domain"] == "me.github.io"


def test_suffix_rules_of_a_file(spark, tmp_path):
    (tmp_path / "rules").write_text("// ===BEGIN ICANN DOMAINS===\ncom\n*.zz // all\n!www.zz\n\n// ===BEGIN PRIVATE DOMAINS===\nblog.com\n")
    rules = domains.suffixes(spark, str(tmp_path / "rules"))
    assert sorted(map(tuple, rules.table.collect())) == [("com", 1), ("www.zz", 4), ("zz", 2)] and rules.depth == 2


def test_valid_urls(column):
    urls = ["http://a.b", "HTTPS://a.b/c", "ftp://a.b", "http://nodot/x.html", "http:///a.b", "http://[::1.2/", "a.b", None]
    assert column(U.is_valid_url, urls) == [True, True, False, False, False, False, False, False]


def test_reference_urls(column):
    lines = [
        "x &lt;ref&gt;see http://a.example/p_(1). and&lt;/ref&gt; http://between.example &lt;ref&gt;ftp://b.example/f?x=1:- &lt;/ref&gt; http://after.example",
        "&lt;ref name=x&gt;http://named.example&lt;/ref&gt;",
        "no reference http://c.example",
    ]
    assert column(U.reference_urls, lines) == [
        ["http://a.example/p_", "http://between.example", "ftp://b.example/f?x=1"], [], [],
    ]


def test_clean_urls(spark):
    df = spark.createDataFrame([(" http://a.b/?x=1&amp;y=2 ",), ("http://a.b/?x=1&y=2",), ("",), ("mailto:x@y.z",), ("http://a.b/&#65;",)], "url string")
    assert sorted(r["url"] for r in files.clean_urls(df).collect()) == ["http://a.b/?x=1&y=2", "http://a.b/A"]
