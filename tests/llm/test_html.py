import html
import re

import pytest
from hearth.llm.html import extract, main_text
from helpers import rows_of

LONG = "This is a long paragraph of the article, and it has the words that are common in a text of this kind, so that it is decided."


def test_pages_of_the_table(spark):
    rows = rows_of("pages")
    df = spark.createDataFrame([(r["page_id"], r["url"], r["html"], "clash") for r in rows], "page_id long, url string, html string, text string").repartition(3)
    got = {r["id"]: r["text"] for r in extract(df).collect()}
    for r in rows:
        article = r["html"].split("<article>")[1].split("</article>")[0].split("<footer")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", article)]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("page,want", [
    ("", ""), ("plain words only", ""), ("<p>", ""), ("<article>short</article>", "short"), ("<", ""), ("<article>a < b &lt;c&gt; &am &eacute;&nbsp;x</article>", "a < b <c> &am é x"),
    (f"<body><p>{LONG}</p><p>Brief.</p></body>", f"{LONG}\nBrief."),
    (f"<main><h1>T</h1><p>{LONG}</p><aside><p>{LONG}</p></aside></main><p>{LONG}</p>", f"T\n{LONG}"),
    (f"<nav><ul><li><a href=x>Home</a></ul></nav><div class='cookie-notice'><p>{LONG}</p></div><article><header><h1>T</h1></header><p>{LONG}<br>more</p></article>", f"T\n{LONG} more"),
    (f"<article><p>{LONG}</p><div id=comments><article class=comment><p>{LONG}</p></article></div><form><p>{LONG}</p></form></article>", LONG),
    (f"<article><p>A<script>var x = '</p>' + \"<p>\";</script> b</p><style>p{{}}</style><!-- <p>no</p> --><p>{LONG}", f"A b\n{LONG}"),
    (f"<div><p>{LONG}</p></div><div><a href=1>one</a> <a href=2>two and more links here to fill the block with link text until it is long</a></div>", LONG),
    (f"<article><p hidden>{LONG}</p><p style='display:none'>{LONG}</p><p class=advert>{LONG}</p><p class=lead>{LONG}</p></article>", LONG),
    (f"<article><ul><li>{LONG}<li>two</ul><table><tr><td>x<td>y</table></article>", f"{LONG}\ntwo\nx\ny"),
    ("<article>The law is <math><mi>E</mi> = <mn>mc</mn></math> here, <label>as noted</label> by <button type=button>all</button></article>", "The law is E = mc here, as noted by all"),
    (f"<body><div><p>{LONG}</p><p>{LONG} <math>a + b</math></p></div><form><label>Name</label><button>Send</button></form></body>", f"{LONG}\n{LONG} a + b"),
    (f"<section class=comments><p>{LONG}</p></section><div class='sidebar'>{LONG}</div>", ""),
    ("<article>" + f"<p>{LONG}</p>" * 3000 + "</article>", "\n".join([LONG] * 3000)),
])
def test_layouts(page, want):
    assert main_text(page) == want


def test_broken_markup_takes_linear_time():
    for page in ("<p " * 50_000, "<a href='" * 50_000, "<!--" * 50_000, "<div>" * 20_000 + "x", "<script>" * 20_000, "&" * 200_000, "<p x=\"" + "y" * 200_000):
        main_text(page)


def test_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, None), (None, "u", ""), (1, None, None)], "page_id long, url string, html string")
    assert sorted((tuple(r) for r in extract(df).collect()), key=str) == sorted([(1, None, ""), (None, "u", ""), (1, None, "")], key=str)
    assert extract(df.limit(0)).collect() == []


@pytest.mark.parametrize("line", [
    "Вчера в городе открылась новая библиотека, в которой собраны книги на многих языках, и первые читатели уже пришли за ними.",
    "昨天市里新开了一座图书馆，馆内收藏了多种语言的书籍，第一批读者已经来到这里借阅，工作人员说以后还会增加更多的座位。",
    "昨日、市内に新しい図書館が開館し、さまざまな言語の本が集められ、最初の利用者がすでに本を借りに訪れているという。",
    "افتتحت أمس في المدينة مكتبة جديدة تضم كتبا بلغات كثيرة وقد جاء إليها القراء الأوائل لاستعارة الكتب منذ الصباح الباكر",
    "Wczoraj w mieście otwarto nową bibliotekę, gdzie zebrano książki w wielu językach, a pierwsi czytelnicy już przyszli po nie rano.",
    "Dün şehirde birçok dilde kitapların toplandığı yeni bir kütüphane açıldı ve ilk okuyucular sabah erkenden kitap almaya geldi.",
])
def test_text_of_other_languages_in_plain_blocks(line):
    links = "<div><a href=1>" + line[:50] + "</a> <a href=2>" + line[50:] + "</a></div>"
    assert main_text(f"<body>{links}<div><p>{line}</p><h2>T</h2><p>{line}</p></div><footer><p>{line}</p></footer></body>") == f"{line}\nT\n{line}"
    if not re.search("[A-Za-z]", line):
        # beside a text in a known language too
        assert main_text(f"<body><p>{LONG}</p><p>{line}</p></body>") == f"{LONG}\n{line}"


@pytest.mark.parametrize("page,want", [
    (f'<div class="layout with-sidebar"><article><h1>T</h1><p>{LONG}</p></article></div>', f"T\n{LONG}"),
    (f'<div class="header"><article><p>{LONG}</p></article></div>', LONG),
    (f'<div class="sidebar"><main><p>{LONG}</p></main></div>', LONG),
    (f'<article><div class="entry-header"><h1>T</h1></div><p>{LONG}</p><section id="discussion"><h2 id="search">Search</h2><p>{LONG}</p></section></article>', f"T\n{LONG}\nSearch\n{LONG}"),
    # what marks are for
    (f'<div class="site-footer"><p>{LONG}</p></div><div id="cookieNotice"><p>{LONG}</p></div><div><p>{LONG}</p></div>', LONG),
    (f'<article><p>{LONG}</p></article><div class="comment-list"><article><p>{LONG} Mine.</p></article></div>', LONG),
    (f'<article><p>{LONG}</p><div class="menu"><a href=1>one of the links</a> <a href=2>two of the links</a></div></article>', LONG),
])
def test_marks_beside_and_around_articles(page, want):
    assert main_text(page) == want
