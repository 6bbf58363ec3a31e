"""Wrappers and page articles."""

import pytest

from loadweave.llm import wrappers


def page(title, blocks, menu="<li><a href='/a'>Home</a></li>", extra=""):
    body = "".join(f"<p>{b}</p>" for b in blocks)
    return (
        f"<html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul>{menu}</ul></nav>"
        f"<div class='ad'>Buy</div><div class='content'><h1>{title}</h1>{body}{extra}</div>"
        f"<div id='comments'><p>First! {title}</p></div><footer>&copy; site</footer></body></html>"
    )


def test_articles(spark):
    rows = [(i, "https://User@News.example.org:80/x", page(f"T{i}", [f"one {i} &amp; <b>two</b>\n three", f"four<br>five {i}"])) for i in range(6)]
    rows += [(10, None, None), (11, "", ""), (12, "no url", "<p>bare <i>text"), (12, "no url", "<p>bare <i>text")]
    rows += [(13, "https://one.example.org", "<article><header><h1>H</h1></header><p>x<aside>no</aside><p>y</article><aside>z</aside>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' as text", "1 as _host")
    got = {}
    for r in wrappers.extract(pages).collect():
        got[r["page_id"]] = r["text"]
        assert r["n_chars"] == len(r["text"])
    for i in range(6):
        assert got[i] == f"T{i}\n\none {i} & two three\n\nfour five {i}"
    assert got[10] == got[11] == ""
    assert got[12] == "bare text"
    assert got[13] == "H\n\nx\n\ny"
    assert wrappers.extract(pages.where("page_id = 99")).count() == 0


def test_wrapper_finds_template_text_and_repeats():
    pages = [page(f"T{i}", [f"p{i} {k}" for k in range(i + 1)], extra="<div>Read on our site</div>") for i in range(5)]
    found = wrappers.infer(pages)
    assert [x.key for x in found.region()] == [("body", ""), ("div", "content")]
    assert "<div><h1>#</h1>(<p>#</p>)+<div>=</div></div>" in found.expression()
    text, by_wrapper = wrappers.article(pages[3], found)
    assert by_wrapper and "Read on" not in text and text.count("p3") == 4


def test_alignment_makes_slots_options_and_repeats():
    found = wrappers.infer(["<ul><li>1</li></ul><p>x</p>", "<ul><li>1</li><li>2</li><li>3</li></ul><hr><table></table><p>y</p>"])
    assert found.expression() == "<ul>(<li>#</li>)+</ul>(<table></table>)?<p>#</p>"
    found = wrappers.infer(["<h2>a</h2><p>b</p>", "<h2>c</h2><p>d</p><h2>e</h2><p>f</p><p>g</p>"])
    assert found.expression() == "(<h2>#</h2>(<p>#</p>)+)+"
    far = "".join(f"<h{1 + k % 6}>t</h{1 + k % 6}><ul></ul>" * (1 + k % 2) for k in range(3000))
    found = wrappers.infer(["<table></table>", far + "<table></table>"])
    assert found.expression().endswith(")?<table></table>")


@pytest.mark.parametrize("url,host", [("HTTP://A.b/c", "a.b"), ("x", ""), (None, ""), ("https://u:p@h:1?q", "h")])
def test_host(spark, url, host):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(wrappers.host_of(df["url"])).first()[0] == host


def test_near_copies_of_one_article_keep_their_paragraphs():
    body = [f"paragraph {k} of the article" for k in range(6)]
    pages = [page(f"T{i}", body) for i in range(8)]
    found = wrappers.infer(pages)
    assert wrappers.article(pages[2], found) == ("\n\n".join(["T2", *body]), True)


def test_template_text_goes_at_its_place_only():
    note = "Read on our site"
    pages = [page(f"T{i}", [f"p{i} {k}" for k in range(4)], extra=f"<div>{note}</div>") for i in range(5)]
    found = wrappers.infer(pages)
    other = page("T9", ["a", note, "b"], extra=f"<div>{note}</div>")
    assert wrappers.article(other, found) == (f"T9\n\na\n\n{note}\n\nb", True)


def test_copies_of_a_page_change_nothing(spark):
    own = [page(f"T{i}", [f"p{i} {k}" for k in range(3)], extra="<div>Read on</div>") for i in range(4)]
    rows = [(f"http://h/{k}", p) for p in own for k in range(20)]
    df = spark.createDataFrame(rows, "url string, html string").repartition(7)
    (made,) = wrappers.host_wrappers(df, "url", "html").collect()
    found, one = wrappers.Wrapper.loads(made["_wrapper"]), wrappers.infer(own)
    assert found.expression() == one.expression()
    assert [x.key for x in found.region()] == [x.key for x in one.region()]
    assert len(found.articles) == len(one.articles) == 4
    assert wrappers.article(own[0], found) == ("T0\n\np0 0\n\np0 1\n\np0 2", True)


def test_two_layouts_of_a_host_without_word_lists(spark):
    """Articles without an article element, and with one; sections named by no known word."""
    note = "Mehr lesen Sie bei unseren Partnern"
    rows, truth = [], {}
    for i in range(40):
        body = [f"satz {i} {k} " + "wort " * (5 + (i * 7 + k) % 9) for k in range(3 + i % 4)]
        truth[i] = "\n\n".join([f"Titel {i}", *(b.strip() for b in body)])
        told = f"<h1>Titel {i}</h1>" + "".join(f"<p>{b}</p>" for b in body)
        said = f"<div class='readers-say'><p>Leser {i}</p><p>noch einer {i}</p></div>"
        house = f"<p class='x7'>{note}</p>"
        if i % 2:
            html = f"<body><div class='q1'><p>Heute {i % 3}</p></div><div class='q2'>{told}{house}</div><div class='q3'>{said}</div></body>"
        else:
            html = f"<body><div class='q1'><p>Heute {i % 3}</p></div><article>{told}{said}{house}</article><div class='q4'><p>{note}</p></div></body>"
        rows.append((i, "http://two.example.org/" + str(i), html))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = wrappers.extract(df).collect()
    assert {r["page_id"]: r["text"] for r in got} == truth
    assert all(r["by_wrapper"] for r in got)
    assert wrappers.host_wrappers(df, "url", "html").count() == 2


def test_odd_pages(spark):
    deep = "<div>" * 5000 + "tief" + "</div>" * 5000 + "<p>flach"
    rows = [(1, "http://h/1", deep), (2, "http://h/2", "<" * 3000), (3, "http://h/3", "</p></div><hr>&nbsp;&lt;x"), (4, None, "<nav>menu")]
    rows += [(5, "http://h/5", "<p>" + "lang " * 200_000)]
    got = {r["page_id"]: r for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1]["text"] == "tief\n\nflach"
    assert got[3]["text"] == "<x"
    assert got[4]["text"] == "" and got[2]["n_chars"] == 3000
    assert got[5]["n_chars"] == 5 * 200_000 - 1
    copies = spark.createDataFrame([(None, "http://h/1", "<p>a"), (None, "http://h/1", "<p>a")], "page_id long, url string, html string")
    assert [r["text"] for r in wrappers.extract(copies).collect()] == ["a", "a"]


def test_alignment_equals_a_plain_search_of_the_paths():
    """Whatever the order of blocks, every page's own tokens match the wrapper made from all."""
    import random

    draw = random.Random(5)
    pages = ["".join(f"<{t}>{draw.random()}</{t}>" for t in draw.choices(["p", "h2", "ul", "table", "pre"], k=draw.randrange(1, 12))) for _ in range(60)]
    found = wrappers.infer(pages)
    for p in pages:
        text, by_wrapper = wrappers.article(p, found)
        assert by_wrapper and text.split("\n\n") == wrappers.re.findall(r"0\.\d+(?:e-\d+)?", p)
