"""Page parsing and text functions (FIXTURES: delimited line, follow page, profile)."""

import json
import re

from pyspark.sql import functions as F

from asklens.functions import text as X
from asklens.operators import profiles as P

# Fixed value: the crawler's tag regex, run with Python's re as the reference does.
PY_TAG = r'(<[\d\w\s\;\:\'\"\,\.\/\?\!\@\#\$\%\^\&\*\(\)\-\_\=\+]+\/*>)'


def test_delimited_line(spark):
    df = spark.createDataFrame([("id:::a---name:::b-c---g:::-1",)], "value string")
    m = df.select(X.decode_record("value").alias("m")).first()["m"]
    assert m == {"id": "a", "name": "b-c", "g": "-1"}


def test_encode_decode_roundtrip(spark):
    df = spark.createDataFrame([("u1", "x-y", -1)], "id string, name string, gender int")
    line = df.select(X.encode_record(("id", F.col("id")), ("name", F.col("name")),
                                     ("gender", F.col("gender"))).alias("l")).first()["l"]
    assert line == "id:::u1---name:::x-y---gender:::-1"


def test_strip_tags_matches_python(spark):
    samples = ["<p>héllo</p> <br/>wörld", "<a href=\"/x?a=1&b=2\">link</a>", "<div class=\"{x}\">keep</div>",
               "a < b > c", "<ü class='ö'>text</ü>", "<b> x</b>", "<span\tid=1>t</span>"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(X.strip_tags("s")).collect()]
    assert got == [re.sub(PY_TAG, "", s) for s in samples]


def test_urls(spark):
    urls = ["https://h/people/abc/following", "https://h/api/v4/members/xy/followees?include=d&offset=20&limit=20",
            "http://h/en/1?page=2&ref=x#top", "https://h/org/z"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    rows = df.select(X.url_route("u").alias("r"), X.url_token("u").alias("t"),
                     X.query_param("u", "offset").alias("o"), X.query_param("u", "page").alias("p"),
                     X.org_token("u").alias("g")).collect()
    assert [r["r"] for r in rows] == ["profile", "follow_api", "other", "other"]
    assert [r["t"] for r in rows] == ["abc", "xy", None, None]
    assert rows[1]["o"] == "20" and rows[2]["p"] == "2"
    assert rows[3]["g"] == "z" and rows[0]["g"] == urls[0]


def test_follow_page_skips_incomplete_elements(spark):
    body = json.dumps({"paging": {"is_end": True}, "data": [
        {"url_token": "a", "url": "https://h/people/a", "name": "A", "gender": 1},
        {"url_token": "b", "url": "https://h/people/b", "gender": 0},
        {"url_token": "c", "url": "https://h/people/c", "name": "C", "gender": -1}]})
    pages = spark.createDataFrame([("https://h/api/v4/members/u/followees?offset=0&limit=20", body)],
                                  "url string, body string")
    got = [(r["user"], r["id"]) for r in P.api_follows(pages).collect()]
    assert got == [("u", "a"), ("u", "c")]


def _user(**drop):
    u = {k: 1 for k in ["followerCount", "followingCount", "answerCount", "questionCount",
                        "commercialQuestionCount", "articlesCount", "favoritedCount", "pinsCount",
                        "logsCount", "voteupCount", "thankedCount", "hostedLiveCount",
                        "followingColumnsCount", "followingTopicCount", "followingQuestionCount",
                        "followingFavlistsCount", "voteToCount", "voteFromCount", "thankToCount",
                        "thankFromCount"]}
    u.update({"id": "i", "urlToken": "t", "name": "n", "isOrg": False, "type": "people", "url": "x",
              "headline": "a\nb", "isActive": 1, "description": "<b>d</b>", "gender": 0, "badge": [],
              "business": {"name": "IT"}, "locations": [{"name": "L"}, {}],
              "educations": [{"school": {"name": "S"}, "major": {"name": "M"}}, {"major": {"name": "Z"}}]})
    for k in drop:
        u.pop(k)
    return json.dumps(u)


def test_profile_quarantine_and_flatten(spark):
    raw = spark.createDataFrame([("ok", _user()), ("bad", _user(business=1)), ("none", None)],
                                "urlToken string, json string")
    status = {r["urlToken"]: r["status"] for r in P.quarantine(raw).collect()}
    assert status == {"ok": "ok", "bad": "ERROR", "none": "ERROR"}
    flat = P.flatten_profile(raw).collect()
    assert len(flat) == 1
    r = flat[0]
    assert r["headline"] == "ab" and r["description"] == "d" and r["business"] == "IT"
    assert r["locations"] == ["L"] and [tuple(e) for e in r["educations"]] == [("S", "M")]


def test_embedded_json(spark):
    body = ('<html><script id="js-initialData" type="text/json">'
            '{"initialState":{"entities":{"users":{"t":' + _user() + ',"o":{"id":"other"}}}}}</script></html>')
    pages = spark.createDataFrame([("https://h/people/t/following", body), ("https://h/people/q/following", "<p/>")],
                                  "url string, body string")
    got = {r["urlToken"]: r["json"] for r in P.embedded_user_json(pages).collect()}
    assert json.loads(got["t"])["id"] == "i" and got["q"] is None


def test_page_links(spark):
    pages = spark.createDataFrame([(1, "https://a.b/x/y?z=1", '<a href="/p">P</a><a href="https://c/d">D</a><a href="/e"></a>')],
                                  "page_id long, url string, html string")
    got = [(r["pos"], r["abs_url"], r["text"]) for r in P.page_links(pages).collect()]
    assert got == [(0, "https://a.b/p", "P"), (1, "https://c/d", "D")]


def test_anchors_in_ordinary_forms(spark):
    html = ("<a class=x href=/people/a>A</a><a href='/b'>B</a><a href=\"/c\"><b>C</b> c</a><A HREF=\"/d\">D</A>"
            "<a\n href = \"/e\" >E</a ><abbr href=\"/no\">no</abbr><a data-href=\"/no\">no</a>")
    pages = spark.createDataFrame([(1, "https://h/", html)], "page_id long, url string, html string")
    got = [(r["href"], r["text"], r["id"], r["gender"]) for r in P.page_links(pages).collect()]
    assert got == [("/people/a", "A", "a", -1), ("/b", "B", None, -1), ("/c", "C c", None, -1), ("/d", "D", None, -1), ("/e", "E", None, -1)]


def test_script_over_lines_and_other_attributes(spark):
    body = ('<script>x</script><script type="text/json" id=\'js-initialData\'>\n'
            '{"initialState":{"entities":{"users":{"t":' + _user() + '}}}}\n</script>')
    pages = spark.createDataFrame([("https://h/people/t/following", body)], "url string, body string")
    assert json.loads(P.embedded_user_json(pages).first()["json"])["id"] == "i"


def test_pages_without_end_flag_give_nothing(spark):
    item = {"url_token": "a", "url": "x", "name": "A", "gender": 1}
    url = "https://h/api/v4/members/u/followees?offset=0&limit=20"
    pages = spark.createDataFrame([(url, json.dumps({"data": [item]})), (url, json.dumps({"paging": {}, "data": [item]})),
                                   (url, json.dumps({"paging": {"is_end": False}, "data": [item]}))], "url string, body string")
    assert P.api_follows(pages).count() == 1


def test_null_headline_is_the_text_none(spark):
    record = json.dumps({**json.loads(_user()), "headline": None})
    raw = spark.createDataFrame([("t", record)], "urlToken string, json string")
    assert [r["headline"] for r in P.flatten_profile(raw).collect()] == ["None"]
    assert [r["value"] for r in P.profile_ledger(raw.unionByName(raw.selectExpr("'q' urlToken", "'{}' json"))).collect()] == ["t", "q:::ERROR"]


def test_integers_as_python_reads_them(spark):
    texts = ["1_000", "٣", "1__0", "_1", "99999999999999999999", " -7 ", "1.0", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(X.tolerant_int("t"), X.too_large_int("t")).collect()]
    want = []
    for t in texts:
        try:
            n = int(t)
        except ValueError:
            n = None
        fits = n is not None and abs(n) < 2**63
        want.append((n if fits else None, n is not None and not fits))
    assert got == want


def test_quarantine_unreadable_values(spark):
    good = json.loads(_user())
    no_desc = dict(good, description=None)
    no_locs = dict(good, locations=None)
    nameless = dict(good, educations=[{"school": {"id": 1}, "major": {"name": "M"}}])
    skipped = dict(good, educations=[{"major": {"name": "M"}}])  # no school: skipped, not an error
    raw = spark.createDataFrame([(k, json.dumps(v)) for k, v in
                                 [("good", good), ("no_desc", no_desc), ("no_locs", no_locs),
                                  ("nameless", nameless), ("skipped", skipped)]],
                                "urlToken string, json string")
    status = {r["urlToken"]: r["status"] for r in P.quarantine(raw).collect()}
    assert status == {"good": "ok", "no_desc": "ERROR", "no_locs": "ERROR", "nameless": "ERROR", "skipped": "ok"}


def test_absolute_url_matches_urljoin(spark):
    from urllib.parse import urljoin
    bases = ["https://a.b/x/y?z=1#f", "http://a.b", "https://a.b/dir/", "http://a.b/p.html#top"]
    hrefs = ["/p", "q.html", "//c.d/e", "https://e.f/g", "?k=2", "#s", "", "sub/t", "../q", "./q", "../../../q?x=../y#../z", "a/../b/./c/", "..", ".",
             "/x/../y", "/../..", "a/..", "//c.d/x/../y", "https://e.f/a/../b", "...", "..a/b..", "a//b", "/a//b/", "a/./", "x/../../..//y"]
    bases += ["https://a.b/x/y/z/w", "https://a.b/x//y/z", "https://a.b/", "https://a.b/../x/"]
    rows = [(b, h) for b in bases for h in hrefs]
    df = spark.createDataFrame(rows, "url string, href string")
    got = [r[0] for r in df.select(X.absolute_url("href", "url")).collect()]
    assert got == [urljoin(b, h) for b, h in rows]


def test_strip_tags_unicode_class_edges(spark):
    # marks, non-breaking and other spaces, separators, other digits, letters of other scripts
    chars = ["́", " ", " ", " ", "\x1c", "\x1f", "\x85", "²", "٣", "一",
             "　", "​", "﻿", "Ⅰ", "ª"]
    samples = [f"x<a{c}b>y" for c in chars] + [f"<{c}>" for c in chars]
    df = spark.createDataFrame(list(enumerate(samples)), "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(X.strip_tags("s")).collect()]
    assert got == [re.sub(PY_TAG, "", s) for s in samples]


def test_links_as_a_parser_reads_them(spark):
    html = ("<!-- <a href='/no'>no</a> --><script>x = \"<a href='/no'>no</a>\"</script><style>a{}</style><A title='a > b' HREF='/people/t&amp;j'>Tom &amp; "
            "J&eacute;r&#244;me &lt;b&gt; <img alt='>'>&#x1F600;&nope; &#0; &amp more</A><a title=\"href='/x'\" data-href=/y href=/z?a=1&amp;b=2>z</a>"
            "<a name=anchor>no link</a><a href=''>empty</a><abbr href=/no>no</abbr><!-- <a href='/no'>no</a>")
    pages = spark.createDataFrame([(1, "https://h/x/y", html)], "page_id long, url string, html string")
    got = [(r["href"], r["text"]) for r in P.page_links(pages).collect()]
    assert got == [("/people/t&j", "Tom & Jérôme <b> \U0001F600&nope; \ufffd & more"), ("/z?a=1&b=2", "z"), ("", "empty")]


def test_names_of_characters(spark):
    from html import unescape

    names = [*X.LATIN_1, *X.OTHER_NAMES]
    texts = [f"a&{n};b" for n in names] + ["&#65;&#x42;", "&#8364;", "&#55296;", "&", "&;", "&#;", "a&amp;lt;", "no reference", "", "&amp;amp;"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(X.unescape("s")).collect()]
    assert got == [unescape(t) for t in texts]
