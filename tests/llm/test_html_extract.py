import html
import random

import pytest

from matchforge.llm.html_extract import best_path, blocks_of, main_text, path_scores, text_of


def plain(page, votes=None):
    blocks, containers = blocks_of(page)
    return text_of(blocks, best_path(path_scores(blocks, containers), votes))


BODY = "<p>First   paragraph\n with <b>bold</b> and <a href=x>a link</a>.</p><p>Second &amp; last&nbsp;one, long enough to be read."
WANT = "First paragraph with bold and a link.\n\nSecond & last one, long enough to be read."

PAGES = [
    # (html, text)
    (f"<html><body><nav><a href=/>Home page and menu</a></nav><article>{BODY}</article><footer>Copyright footer</footer></body></html>", WANT),
    (f"<body><div id=main-content>{BODY}</div><div class='sidebar'><p>Sidebar text, rather long, longer than what the page has to say itself, and more.</p></div>", WANT),
    (f"<main><div class='post-12 has-sidebar'>{BODY}<div class=ad><p>Buy now</div><section id=comments><p>Nice post!<p>Indeed.</section></div></main>", WANT),
    (f"<article>{BODY}<script>if (a < b) document.write('</p><p>no')</script><style>p{{}}</style><!-- <p>no</p> --><form><p>Mail <input></form></article>", WANT),
    (f"<div class=wrap><div class=cookie-notice><p>We use cookies and more cookies.</p></div><div class=text>{BODY}</div></div>", WANT),
    (f"<html><head><title>T</title><meta charset=utf-8><body class='comments-open'><article>{BODY}", WANT),
    ("<article><h1>Head</h1><ul><li>one<li>two <i>and</i> three</ul><table><tr><td>a<td>b<tr><td>c</table><p>x<br>y</article>", "Head\n\none\n\ntwo and three\n\na\n\nb\n\nc\n\nx y"),
    ("<article><section><p>Part one of it.</section><section><p>Part two of it.</section></article>", "Part one of it.\n\nPart two of it."),
    ('<article><p title="a > b" class=x>Quoted <span class="ad">buy <b>this</b></span>mark</p></article>', "Quoted mark"),
    ("<article><p>cut off &am", "cut off &am"),
    ("<article><p>cut off <a hre", "cut off"),
    ("<article><p>1 < 2 & 3 > 2 &lt;b&gt; &#233;&#x1F600; &copy</article>", "1 < 2 & 3 > 2 <b> é😀 ©"),
    ("just text, no tags", "just text, no tags"),
    ("<ARTICLE><P>Upper<P>case</ARTICLE>", "Upper\n\ncase"),
    ("<nav>menu</nav>", ""), ("", ""), ("<!-- only -->", ""), ("<p>", ""), ("<", "<"),
    ("<article><p>unclosed comment <!-- rest", "unclosed comment"),
    ("<article><p>a</p><script>never closed <p>b", "a"),
    ("</div></p></article><article><p>stray end tags</p></div></article>", "stray end tags"),
    ("<article><pre>  keep\n   one space </pre><blockquote><p>quoted</blockquote>after</article>", "keep one space\n\nquoted\n\nafter"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_pages_of_their_own(page, text):
    assert plain(page) == text


def test_paths_are_generalised_by_host():
    a, b = (blocks_of(f"<div class='Post-{k} x'><p>word</div>")[1][-1].path for k in (12, 7))
    assert a == b == "html>body>div.post-#.x"


def template(kind, title, paragraphs, junk):
    inner = "".join(f"<p>{html.escape(p)}</p>" for p in paragraphs)
    if kind == 0:
        return f"<body><div class=top>{junk}</div><div class='col-{len(title)}'><h1>{title}</h1>{inner}</div><div class=extra><p>{junk}</p></div></body>"
    return f"<body><table><tr><td class=left><p>{junk}</p><td class=right><h1>{title}</h1>{inner}</table></body>"


def site(seed, n=120):
    r = random.Random(seed)
    rows, want = [], {}
    for i in range(n):
        host = r.choice(["a.example", "a.example", "b.example"])
        paragraphs = [" ".join(r.choice(["alpha", "beta", "<gamma>", "d&e"]) for _ in range(r.randint(20, 80))) for _ in range(r.randint(1, 6))]
        if i % 12 == 0:
            paragraphs = ["tiny"]  # the page's own best container is the junk
        page = template(host == "b.example", f"Title {i}", paragraphs, "some text that stands on every page of this host " * 2)
        rows.append((i, f"https://user@{host.upper()}:80/{i}?q" if i % 3 else f"http://{host}/", page))
        want[i] = "\n\n".join([f"Title {i}", *paragraphs])
    return rows, want


def test_hosts_agree_on_paths(spark):
    rows, want = site(3)
    got = {r.page_id: r for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert any(plain(h) != want[i] for i, _, h in rows)  # alone, a tiny page takes the junk
    assert {r.path for r in got.values()} == {"html>body>div.col-#", "html>body>table>tr>td.right"}


def test_equals_votes_counted_in_plain_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = pages.collect()
    votes = {}
    for r in rows:
        host = r.url.split("//")[1].split("/")[0].split("?")[0].split("#")[0].lower()
        p = best_path(path_scores(*blocks_of(r.html)))
        if p:
            votes.setdefault(host, []).append(p)
    for r in main_text(pages).collect():
        host = r.url.split("//")[1].split("/")[0].split("?")[0].split("#")[0].lower()
        v = votes.get(host, [])
        share = {p: v.count(p) / len(v) for p in v if v.count(p) >= 0.1 * len(v)}
        page = next(x.html for x in rows if x.page_id == r.page_id)
        assert r.text == plain(page, share)


def test_odd_input(spark):
    long = "<article>" + "<p>word " * 400_000 + "</article>"  # 3 MB
    deep = "<div>" * 20_000 + "deep"
    rows = [(1, None, None), (2, "no host", ""), (None, "http://h/", "<article><p>x</article>"), (3, "http://h/", "<article><p>x</article>"),
            (3, "http://h/", "<article><p>x</article>"), (4, "http://h/", long), (5, "http://d/", deep), (6, "http://q/", "<p a='" * 3_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'w' AS winners", "'h' AS host", "1 AS path", "'t' AS text")
    got = main_text(df).collect()
    texts = sorted((-1 if r.page_id is None else r.page_id, r.text) for r in got)
    assert [i for i, _ in texts] == [-1, 1, 2, 3, 3, 4, 5, 6]
    assert dict(texts) == {-1: "x", 1: "", 2: "", 3: "x", 4: "\n\n".join(["word"] * 400_000), 5: "deep", 6: ""}
    assert main_text(df.where("false")).collect() == []
