from featurelake.llm import wrappers

SCHEMA = "page_id long, url string, html string, text string, wrapper string"


def page(i, paragraphs, extra="", tail="</body></html>"):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var x='</p><p>no</p>';</script></head><body>"
            f"<header><a href='/'>Site</a></header><nav><ul><li><a>Home</a></li><li><a>About {i}</a></li></ul></nav><!-- <p>no</p> -->"
            f"<div class='cookie-notice'>We use cookies</div><div class=\"ad\">Buy {i}</div><article><h1>Title {i}</h1>{body}{extra}</article>"
            f"<aside>More {i}</aside><form><input><label>Mail</label></form><div id='comments'><p>Nice {i}!</p></div>"
            f"<footer>&copy; me</footer>{tail}")


def texts(spark, rows):
    got = wrappers.main_text(spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], SCHEMA)).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    return {r["page_id"]: r["text"] for r in got}


def test_articles(spark):
    url = "https://a.example.com/p"
    rows = [(i, f"{url}/{i}", page(i, [f"Para {i} {k} &amp; <b>bold</b>\n  end" for k in range(i)])) for i in range(5)]
    rows.append((10, url, page(10, ["one<br>two", "a&nbsp;b &lt;c&gt; &#233;"], "<p><b>open<br><p>last <div class='share'>tweet</div>", "")))
    rows.append((11, url, page(11, ["x"], "<ul><li>one<li>two</ul><table><tr><td>1<td>2</table>")))
    rows.append((12, url, page(12, ["y" * 60000])))
    got = texts(spark, rows)
    for i in range(5):
        assert got[i] == "\n".join([f"Title {i}", *(f"Para {i} {k} & bold end" for k in range(i))])
    assert got[10] == "Title 10\none two\na b <c> é\nopen\nlast"
    assert got[11] == "Title 11\nx\none\ntwo\n1\n2"
    assert got[12] == "Title 12\n" + "y" * 60000


def test_without_an_article_fixed_texts_are_surroundings(spark):
    rows = [(i, "http://b.example.org/", f"<body><div>Our site</div><div><p>Story {i}</p><p>Part {i}</p></div><div>All rights</div></body>")
            for i in range(4)]
    got = texts(spark, rows)
    assert got == {i: f"Story {i}\nPart {i}" for i in range(4)}


def extracted(pages):
    parsed = [wrappers.parse(p) for p in pages]
    items = wrappers.expression(parsed[0], hash(pages[0]))
    for tree, p in zip(parsed[1:], pages[1:]):
        items = wrappers.align(items, wrappers.expression(tree, hash(p)))
    found = wrappers.Wrapper(items)
    return [found.text(tree) for tree in parsed]


def test_pages_without_an_article_beside_marked_ones():
    plain = [f"<div>Our site</div><section><p>Story {i}</p></section>" for i in range(4)]
    marked = [f"<div>Our site</div><article><p>Told {i}</p></article><p>Other {i}</p>" for i in range(2)]
    assert extracted(plain + marked) == [[f"Story {i}"] for i in range(4)] + [[f"Told {i}"] for i in range(2)]


def test_copies_are_one_page_and_long_notices_are_fixed(spark):
    copy = "<h1>Title</h1><div>Short</div>"
    notice = "All rights reserved. " * 20
    rows = [(i, "http://copies.example/", copy) for i in range(6)]
    rows += [(10 + i, "http://long.example/", f"<div>{notice}</div><p>Story {i}</p>") for i in range(4)]
    got = texts(spark, rows)
    assert all(got[i] == "Title\nShort" for i in range(6)) and all(got[10 + i] == f"Story {i}" for i in range(4))


def test_edges(spark):
    rows = [(1, None, None), (2, "", ""), (3, "nonsense", "plain text"), (4, "http://c.example/", "<p>a < b and c</p><p"), (None, None, "<"),
            (5, "http://c.example/", "<!-- never closed <p>x</p>"), (5, "http://c.example/", "<!-- never closed <p>x</p>")]
    got = wrappers.main_text(spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], SCHEMA)).collect()
    assert len(got) == 7
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == by[2] == by[5] == "" and by[3] == "plain text" and by[4] == "a < b and c"
    assert wrappers.main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_alignment_gives_optional_and_repeated_groups():
    def shape(items):
        return [e[0] + (e[1] if e[0] == "n" else "".join(shape(e[1]) if e[0] in "ro" else "")) for e in items]

    a = wrappers.expression(wrappers.parse("<h1>a</h1><p>1</p><p>2</p><hr><p>x</p>"))
    b = wrappers.expression(wrappers.parse("<h1>b</h1><p>1</p><hr><div>new</div><p>x</p>"))
    got = wrappers.align(a, b)
    assert shape(got) == ["nh1", "rnp", "nhr", "ondiv", "np"]
    assert got[0][3][0][1] is None and got[4][3][0][1] == "x"
    pair = wrappers.expression(wrappers.parse("<dl><dt>a<dd>1<dt>b<dd>2</dl>"))
    once = wrappers.expression(wrappers.parse("<dl><dt>a<dd>1</dl>"))
    assert shape(wrappers.align(pair, once)[0][3]) == ["rndtndd"]
    again = wrappers.align(got, a)
    assert shape(again) == shape(got)
