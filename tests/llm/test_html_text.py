import re
from html.parser import HTMLParser
from math import e, log

import pytest

from asklens.llm import html_text
from asklens.llm.queries import op13_html_extraction

SF = "/root/testdata/sf0.001"
LONG_1 = "The first paragraph runs on for a good while so that it has some weight of its own."
LONG_2 = "A second paragraph follows it, again with plenty of words and not a single link in it."
LONG_3 = "The third one closes the piece with yet another sentence that is not short at all."
MENU = "<ul>" + "".join(f"<li><a href='/{i}'>entry {i}</a></li>" for i in range(8)) + "</ul>"


class Article(HTMLParser):
    """The blocks of the article element, read by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        self._mark(tag)

    def handle_endtag(self, tag):
        self._mark(tag)
        if tag == "article":
            self.inside = False

    def _mark(self, tag):
        if tag in ("p", "h1", "article"):
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data

    def text(self):
        return " ".join(t for t in (" ".join(b.split()) for b in self.blocks) if t)


def by_standard_parser(html):
    reader = Article()
    reader.feed(re.sub(r"<script>.*?</script>", "", html, flags=re.DOTALL))
    reader.close()
    return reader.text()


def test_query_gives_the_article_of_every_page(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op13_html_extraction(spark, SF)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert len(rows) == len(pages)
    for r in rows:
        page = pages[r["page_id"]]
        assert r["text"] == by_standard_parser(page["html"]) and r["text"]
        assert r["n_chars"] == len(r["text"]) and r["url"] == page["url"]


ARTICLE = f"<h1>Head</h1><p>{LONG_1}</p><p>ok</p><p>{LONG_2}</p><p>{LONG_3}</p>"
WHOLE = f"Head {LONG_1} ok {LONG_2} {LONG_3}"


@pytest.mark.parametrize("around", [
    "{}", "<header><p>The name of the site, and its claim, in a long line</p></header>{}", "<nav>" + MENU + "</nav>{}",
    "<div class='menu main'>" + MENU + "</div>{}", MENU + "{}", "{}<footer>&copy; all of the rights are reserved by someone</footer>",
    "{}<div id=footer>all of the rights are reserved by someone somewhere</div>", "{}<aside><p>" + LONG_3[::-1] + "</p></aside>",
    "<div class=sidebar-left><p>" + LONG_2[::-1] + "</p></div>{}", "<div id='cookieNotice'><p>" + LONG_2[::-1] + "</p></div>{}",
    "<div class=ad>" + LONG_1[::-1] + "</div>{}", "<form><p>" + LONG_1[::-1] + "</p><input><button>send</button></form>{}",
    "<script>var t='</p><p>" + LONG_1 + "</p>'</script><style>p {{ x: y }}</style>{}",
    "{}<section id=comments><h2>Remarks</h2>" + "<div class=comment><p>" + LONG_1[::-1] + "</p></div>" * 9 + "</section>",
    "{}<div class='comment-list'><article class=comment><p>" + LONG_1[::-1] + "</p></article></div>",
    "<div role=navigation>" + MENU + "</div><div hidden><p>" + LONG_1[::-1] + "</p></div>{}<!-- <p>" + LONG_1 + "</p> -->",
])
@pytest.mark.parametrize("article", ["<article>{}</article>", "<div><div class=text>{}</div></div>", "<main><section>{}</section></main>"])
def test_article_without_what_stands_around_it(around, article):
    page = "<html><head><title>Head</title></head><body>" + around.format(article.format(ARTICLE)) + "</body></html>"
    assert html_text.main_text(page)[0] == WHOLE


def test_noise_inside_the_article_goes():
    inside = f"<article><header><h1>Head</h1></header><p>{LONG_1}</p><p>ok</p><div class='share bar'>{MENU}</div><p>{LONG_2}</p>" \
             f"<aside>{LONG_1}</aside><p>{LONG_3}</p><form>{LONG_1}</form></article>"
    assert html_text.main_text(f"<body>{inside}</body>")[0] == WHOLE


def test_sections_are_found_whole():
    page = f"<body><nav>{MENU}</nav><div><section><p>{LONG_1}</p><p>so</p></section><section><p>{LONG_2}</p></section></div>" \
           f"<div><p><a href=x>short</a> <a href=y>links</a></p></div></body>"
    assert html_text.main_text(page)[0] == f"{LONG_1} so {LONG_2}"


def test_markup_as_browsers_read_it():
    assert html_text.main_text("<p>a &lt;b&gt; &amp c&nbsp;d &am;<p>x <b>y<br>z<p>3 < 4 <i>un</i>done")[0] == "a <b> & c d &am; x y z 3 < 4 undone"
    assert html_text.main_text("<ul><li>one<li>two <b>bold</b>er</ul>")[0] == "one two bolder"
    assert html_text.main_text("<table><tr><td>a<td>b<tr><td>c</table>")[0] == "a b c"
    assert html_text.main_text("<p>kept <a href='broken")[0] == "kept"
    assert html_text.main_text("<p>kept<!-- open <p>gone")[0] == "kept"
    assert html_text.main_text("<p title='a > b'>kept</p><script>open <p>gone")[0] == "kept"
    for empty in (None, "", " \n", "<html><body></body></html>", "<script>x</script>", "<title>only</title>"):
        assert html_text.main_text(empty)[0] == ""
    assert html_text.main_text(f"<body><nav>{LONG_1}</nav></body>")[0] == LONG_1  # a page of nothing else


def test_long_and_deep_pages_are_read_whole():
    many = [f"Paragraph {i} of a long page with some more words." for i in range(20_000)]
    assert html_text.main_text("<body><div>" + "".join(f"<p>{m}" for m in many))[0] == " ".join(many)
    assert html_text.main_text("<div>" * 30_000 + LONG_1 + "</div>" * 30_000)[0] == LONG_1
    assert html_text.main_text("<b>" * 30_000 + LONG_1 + "</i>" * 30_000)[0] == LONG_1


def slow_densities(page, kept):
    """The formulas by recursion over the tree, without running sums."""
    def stats(i):
        link = page.tags[i] == "a"
        c = lc = t = lt = 0
        for item in page.items[i]:
            if isinstance(item, str):
                c += len("".join(item.split()))
            elif kept[item]:
                a, b, x, y = stats(item)
                c, t, lc, lt = c + a, t + b + 1, lc + x, lt + y + (page.tags[item] == "a")
        return c, t, c if link else lc, lt

    body = page.tags.index("body")
    bc, _, blc, _ = stats(body)

    def composite(c, t, lc, lt):
        if not c:
            return 0.0
        if not blc:
            return c / max(t, 1)
        return c / max(t, 1) * log(c / max(lc, 1) * max(t, 1) / max(lt, 1), log(c / max(c - lc, 1) * lc + blc / bc * c + e))

    return [composite(*stats(i)) if kept[i] else 0.0 for i in range(len(page.tags))]


def test_densities_against_recursion(spark):
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").limit(20).collect()]
    pages.append(f"<body>{MENU}<div><p>{LONG_1} <a href=x>with a link</a></p><p>{LONG_2}</p></div></body>")
    for html in pages:
        page = html_text.Page(html)
        for kept in (html_text.kept_nodes(page), [True] * len(page.tags), html_text.kept_nodes(page, strict=False)):
            dense, sums, chars = html_text.densities(page, kept)
            assert dense == pytest.approx(slow_densities(page, kept))
            core = max(range(len(sums)), key=sums.__getitem__)
            assert chars[core] > 0


def test_odd_tables(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars string"
    rows = [(1, "u", f"<body><article>{ARTICLE}</article></body>", "x", "y")] * 2 + [(None, None, None, None, None), (2, None, "", "x", "y")]
    got = html_text.extract_main_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["page_id"] or 0, r["url"] or "", r["text"], r["n_blocks"]) for r in got) == [
        (0, "", "", 0), (1, "u", WHOLE, 5), (1, "u", WHOLE, 5), (2, "", "", 0)]
    assert {r["main_path"] for r in got} == {"", "body/article"}
    assert html_text.extract_main_text(spark.createDataFrame([], schema)).collect() == []
