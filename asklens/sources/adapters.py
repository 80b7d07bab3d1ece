"""Driver tables -> the reference's input shapes (profiles, follow documents,
answer actions, id map, ledgers, raw pages).

Every rule here is expressible in plain SQL as well; ``asklens.plans.oracle``
restates each one for the DuckDB check.  Arrays built here are bounded by
construction, never by a cap on the data:

* ``educations`` holds one (school, major) element per order of a user, none
  dropped.  A user with more than ``PAGE_SIZE`` of them has several documents (page 0, 1, ...),
  one for every ``PAGE_SIZE`` orders; a mix of the order's key says to which an order goes, so
  a user owning a third of all orders is spread over many small rows.  The records of ``profile_flatten``
  are cut by exact positions in order-key order instead (``positions``), at most ``PAGE_SIZE`` elements a document.
* a follow document is one page of ``PAGE_SIZE`` follows (the follow-list
  API pages by 20): the lines of an order are numbered in list order
  (line, supplier, part) without a per-order window (``rank_within_group``
  spreads a large order over several tasks) and cut into pages of 20.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asklens.schemas import PROFILE_COUNTERS
from asklens.session import checkpoint
from asklens.sources.tables import Tables

# Fixed values of the adapters (shared with the SQL oracle).
PAGE_SIZE = 20  # follows per follow document (one API page)
USER_ORDERS = 100_000  # orders of chosen users that are sent to every task (10 MB)
PAGE_SPACE, PAGE_MIX = 1 << 32, 1640531527  # of an order's page of educations
HOST = "https://www.example.com"


def token(col: str | Column) -> Column:
    """User token of a numeric key: 'u' || key."""
    return F.concat(F.lit("u"), F.col(col).cast("string") if isinstance(col, str) else col.cast("string"))


def json_string(col: Column) -> Column:
    """A string column as a JSON string literal (quotes and backslashes escaped)."""
    return F.concat(F.lit('"'), F.regexp_replace(col, r'(["\\])', r'\\$1'), F.lit('"'))


def object_id(col: str | Column) -> Column:
    """24-hex-digit document id of a numeric key (orders like the key)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lpad(F.hex(c), 24, "0")


def _counter(i: int) -> Column:
    return F.pmod(F.col("c_custkey") * F.lit(i + 3), F.lit(1000 + i)).cast("long")


EDUCATIONS = "array<struct<school:string,major:string>>"


def _mixed(key: Column) -> Column:
    """An integer key spread over 0 .. 2^32 - 1 (multiplicative mixing; 64-bit arithmetic does not overflow)."""
    return key.cast("long") % F.lit(PAGE_SPACE) * F.lit(PAGE_MIX) % F.lit(PAGE_SPACE)


def _educations(t: Tables, positions: bool = False) -> DataFrame:
    """(c_custkey, page, educations): one element per order in order-key order, about PAGE_SIZE a page.

    The number of a user's pages comes from one count with map-side combine; the page of an
    order from its own key, so no order has to know its position among the others.  With ``positions``
    a page is ``PAGE_SIZE`` orders by exact position (``rank_within_group``), the last one the rest."""
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey",
                             F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("school"),
                             F.col("o_orderstatus").alias("major"))
    if positions:
        return _educations_by_position(orders)
    per_user = orders.groupBy("c_custkey").agg(F.ceil(F.count(F.lit(1)) / PAGE_SIZE).alias("_pages"))
    page = F.shiftright(_mixed(F.col("o_orderkey")) * F.col("_pages"), 32).alias("page")
    pages = (orders.join(per_user, "c_custkey").groupBy("c_custkey", page)
             .agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "school", "major"))).alias("e")))
    return pages.select("c_custkey", "page", F.transform("e", lambda x: F.struct(
        x["school"].alias("school"), x["major"].alias("major"))).alias("educations"))


def _educations_by_position(orders: DataFrame) -> DataFrame:
    from asklens.operators.graph import rank_within_group

    placed = rank_within_group(orders.withColumn("_no_key", F.col("o_orderkey").isNull()), "c_custkey",
                               ["_no_key", "o_orderkey", "school", "major"], "_pos")
    pages = (placed.groupBy("c_custkey", F.floor(F.col("_pos") / PAGE_SIZE).cast("long").alias("page"))
             .agg(F.array_sort(F.collect_list(F.struct("_pos", "school", "major"))).alias("e")))
    return pages.select("c_custkey", "page", F.transform("e", lambda x: F.struct(
        x["school"].alias("school"), x["major"].alias("major"))).alias("educations"))


def profiles(t: Tables, educations: bool = False, locations: bool = True) -> DataFrame:
    """Flattened user profiles in the fixed streaming schema.

    One row per customer, its educations left null; with ``educations`` one row per customer and
    page of educations.  ``locations=False`` leaves the location null (no join with nation)."""
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    rule = F.col("c_custkey") % 10
    if educations:
        c = c.join(_educations(t), "c_custkey", "left")
        edus = (F.when(rule == 0, F.array().cast(EDUCATIONS)).when(rule == 1, F.lit(None))
                .otherwise(F.col("educations")))
    else:
        edus = F.lit(None).cast(EDUCATIONS)
    if locations:
        n = t.nation.select("n_nationkey", "n_name")
        c = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        place = F.array(F.col("n_name"))
    else:
        place = F.lit(None).cast("array<string>")
    is_org = (F.col("c_custkey") % 13) == 0
    return (c.select(
                object_id("c_custkey").alias("_id"),
                F.md5(F.col("c_custkey").cast("string")).alias("id"),
                token("c_custkey").alias("urlToken"),
                F.col("c_name").alias("name"),
                is_org.alias("isOrg"),
                F.when(is_org, "organization").otherwise("people").alias("type"),
                F.concat(F.lit(HOST), F.when(is_org, "/org/").otherwise("/people/"),
                         token("c_custkey")).alias("url"),
                F.concat_ws(" ", "c_mktsegment", "c_name").alias("headline"),
                F.lit(1).cast("long").alias("isActive"),
                F.concat(F.lit("<b>"), F.col("c_mktsegment"), F.lit("</b> "), F.col("c_name")).alias("description"),
                ((F.col("c_custkey") % 3) - 1).cast("int").alias("gender"),
                F.array().cast("array<string>").alias("badge"),
                *[_counter(i).alias(name) for i, name in enumerate(PROFILE_COUNTERS)],
                F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("business"),
                place.alias("locations"),
                edus.alias("educations"),
            ))


def follow_rows(t: Tables, users: list[str] | None = None) -> DataFrame:
    """Flat follow rows: one per line item, the follower being the order's customer.

    ``users`` (tokens) keeps those followers only, by their numeric keys, so the
    filter reaches the scan of orders.  Up to ``USER_ORDERS`` orders go to every task, so the line items
    are filtered where they are read, not shuffled and sorted for the join."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    if users is not None:
        o = o.where(F.col("o_custkey").isin([int(u[1:]) for u in users if u[:1] == "u" and u[1:].isdecimal()]))
        if o.limit(USER_ORDERS + 1).count() <= USER_ORDERS:
            o = F.broadcast(o)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))


def follow_pairs(t: Tables) -> DataFrame:
    """(src, dst) tokens, one row per follow: exactly the explode of ``follow_docs``
    (tests assert it), without assembling and re-splitting the documents."""
    return follow_rows(t).select(token("o_custkey").alias("src"), token("l_suppkey").alias("dst"))


def paged_follow_rows(t: Tables, users: list[str] | None = None) -> DataFrame:
    """Follow rows with ``page``: position in the order's list (line, supplier, part) div PAGE_SIZE.

    ``users`` keeps only those followers' orders; a page depends on its own
    order only, so the pages of the kept orders are the same either way.
    """
    from asklens.operators.graph import rank_within_group

    rows = follow_rows(t, users)
    if users is not None:
        rows = checkpoint(rows)  # read four times below
    # An order of at most PAGE_SIZE lines is one page; only longer orders need
    # positions, so only their lines are ranked (a partial count finds them).
    long_orders = (rows.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_n"))
                   .where(F.col("_n") > PAGE_SIZE).select("l_orderkey"))
    short = rows.join(long_orders, "l_orderkey", "left_anti").withColumn("page", F.lit(0).cast("long"))
    ranked = rank_within_group(rows.join(long_orders, "l_orderkey", "left_semi"), "l_orderkey",
                               ["l_linenumber", "l_suppkey", "l_partkey"], "_pos")
    paged = ranked.withColumn("page", F.floor(F.col("_pos") / PAGE_SIZE).cast("long")).drop("_pos")
    return short.unionByName(paged)


def follow_docs(t: Tables, users: list[str] | None = None) -> DataFrame:
    """Follow documents: one per (order, page of PAGE_SIZE lines), arrays in list order.

    Line numbers repeat within an order in the driver's data, so list order is
    (line, supplier, part)."""
    rows = paged_follow_rows(t, users)
    item = F.struct(
        F.col("l_linenumber").alias("pos"),
        F.col("l_suppkey").alias("supp"),
        F.col("l_partkey").alias("part"),
        token("l_suppkey").alias("urlToken"),
        F.concat(F.lit("User#"), F.col("l_suppkey").cast("string")).alias("name"),
        F.col("l_partkey").cast("string").alias("topic_id"),
    )
    docs = (rows.groupBy("l_orderkey", "page", "o_custkey", "o_orderpriority")
            .agg(F.array_sort(F.collect_list(item)).alias("items")))
    return docs.select(
        F.concat(F.lpad(F.hex("l_orderkey"), 20, "0"), F.lpad(F.hex("page"), 4, "0")).alias("_id"),
        token("o_custkey").alias("urlToken"),
        F.transform("items", lambda x: F.struct(x["urlToken"].alias("urlToken"),
                                                x["name"].alias("name"))).alias("following"),
        F.array(F.struct(F.col("l_orderkey").cast("string").alias("id"),
                         F.col("o_orderpriority").alias("title"))).alias("question"),
        F.transform("items", lambda x: F.struct(
            x["topic_id"].alias("id"),
            F.concat(F.lit("Topic#"), x["topic_id"]).alias("title"))).alias("topic"),
    )


# Event type -> answer action type.  Events of type FOLLOW_EVENT
# are not answer actions: they stand for the questions a user follows (the
# question lists of the user's follow documents).
ACT_TYPES = {
    "click": "answer_approve",
    "purchase": "answer_collect",
    "view": "answer_comment",
    "signup": "answer_publish",
}
FOLLOW_EVENT = "error"


def _act_type(col: Column) -> Column:
    expr = None
    for ev, act in ACT_TYPES.items():
        expr = (F.when(col == ev, act) if expr is None else expr.when(col == ev, act))
    return expr.otherwise("answer_publish")


def actions(t: Tables) -> DataFrame:
    """Answer actions (event_id, userUrlToken, questionId, actType) from events."""
    return t.events.where(F.col("event_type") != FOLLOW_EVENT).select(
        "event_id",
        token("user_id").alias("userUrlToken"),
        F.get_json_object("props", "$.k").alias("questionId"),
        _act_type(F.col("event_type")).alias("actType"),
    )


def question_follows(t: Tables) -> DataFrame:
    """(userUrlToken, questionId): questions users follow, from follow events."""
    return t.events.where(F.col("event_type") == FOLLOW_EVENT).select(
        token("user_id").alias("userUrlToken"),
        F.get_json_object("props", "$.k").alias("questionId"),
    )


def actions_with_gaps(t: Tables) -> DataFrame:
    """Actions where some records miss a key (forced nulls by residue class)."""
    e = F.col("event_id")
    a = actions(t)
    return a.select(
        "event_id",
        F.when(e % 7 == 3, F.lit(None)).otherwise(F.col("userUrlToken")).alias("userUrlToken"),
        F.when(e % 11 == 4, F.lit(None)).otherwise(F.col("questionId")).alias("questionId"),
        F.when(e % 13 == 5, F.lit(None)).otherwise(F.col("actType")).alias("actType"),
    )


def question_id_texts(t: Tables) -> DataFrame:
    """(event_id, qtext): question ids as text, some padded, some not integers."""
    e = F.col("event_id")
    k = F.get_json_object("props", "$.k")
    text = (F.when(e % 4 == 1, F.concat(F.lit(" "), k, F.lit(" ")))
            .when(e % 4 == 2, F.concat(k, F.lit(".5")))
            .when(e % 8 == 3, F.concat(F.lit("+"), k))
            .otherwise(k))
    return t.events.select("event_id", text.alias("qtext"))


def id_map(t: Tables, gaps: bool = False) -> DataFrame:
    """User id map (_id, urlToken, UId text), some tokens repeated; with ``gaps`` one residue class is
    missing (users without an id, the feature of ``user_id_lookup``)."""
    c = t.customer.select("c_custkey")
    if gaps:
        c = c.where(F.col("c_custkey") % 9 != 4)
    first = c.select(object_id("c_custkey").alias("_id"), token("c_custkey").alias("urlToken"),
                     F.col("c_custkey").cast("string").alias("UId"))
    dup = (c.where(F.col("c_custkey") % 5 == 0)
           .select(object_id(F.col("c_custkey") + F.lit(1000000000)).alias("_id"),
                   token("c_custkey").alias("urlToken"),
                   (F.col("c_custkey") + F.lit(500000)).cast("string").alias("UId")))
    return first.unionByName(dup)


def done_ledger(t: Tables) -> DataFrame:
    """Progress ledger lines (value): users with key = 0 mod 3 are done."""
    k = F.col("c_custkey")
    tok = token("c_custkey")
    line = (F.when(k % 9 == 0, F.concat(tok, F.lit(":::ERROR")))
            .when(k % 2 == 0, F.concat(tok, F.lit(":::"), (k % 7).cast("string")))
            .otherwise(tok))
    return t.customer.select("c_custkey").where(k % 3 == 0).select(line.alias("value"))


def raw_profile_json(t: Tables, positions: bool = False) -> DataFrame:
    """(urlToken, json): the user object as the profile page embeds it.

    Nested like the site's API: business {name}, locations [{name}], educations
    [{school {name}, major {name}}].  Some records miss a required key
    (business when key = 3 mod 17, headline when key = 5 mod 19); a location
    element without a name and education elements without a school are mixed in.
    """
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    edus = F.transform(
        F.coalesce(F.col("educations"), F.array().cast(EDUCATIONS)),
        lambda e: F.struct(
            F.when(e["school"].isNotNull(), F.struct(e["school"].alias("name"))).alias("school"),
            F.struct(e["major"].alias("name")).alias("major")))
    is_org = (k % 13) == 0
    user = F.struct(
        F.md5(k.cast("string")).alias("id"),
        token("c_custkey").alias("urlToken"),
        F.col("c_name").alias("name"),
        is_org.alias("isOrg"),
        F.when(is_org, "organization").otherwise("people").alias("type"),
        F.concat(F.lit(HOST), F.lit("/people/"), token("c_custkey")).alias("url"),
        F.when(k % 19 == 5, F.lit(None))
         .otherwise(F.concat(F.col("c_mktsegment"), F.lit("\n"), F.col("c_name"))).alias("headline"),
        F.lit(1).cast("long").alias("isActive"),
        F.concat(F.lit("<p>"), F.col("c_name"), F.lit("</p><br/>"), F.col("c_mktsegment")).alias("description"),
        ((k % 3) - 1).cast("int").alias("gender"),
        F.array().cast("array<string>").alias("badge"),
        *[_counter(i).alias(name) for i, name in enumerate(PROFILE_COUNTERS)],
        F.when(k % 17 == 3, F.lit(None))
         .otherwise(F.struct(F.col("c_mktsegment").alias("name"))).alias("business"),
        F.array(F.struct(F.col("n_name").alias("name")),
                F.struct(F.lit(None).cast("string").alias("name"))).alias("locations"),
        edus.alias("educations"),
    )
    return (c.join(_educations(t, positions), "c_custkey", "left")
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(token("c_custkey").alias("urlToken"),
                    F.to_json(user).alias("json")))


def profile_pages(t: Tables) -> DataFrame:
    """(url, body): profile pages embedding the user object in a script tag."""
    p = raw_profile_json(t)
    body = F.concat(
        F.lit('<html><head><title>profile</title></head><body><div id="root"></div>'
              '<script id="js-initialData" type="text/json">{"initialState":{"entities":{"users":{'),
        json_string(F.col("urlToken")), F.lit(":"), F.col("json"),
        F.lit("}}}}</script></body></html>"))
    return p.select(
        F.concat(F.lit(HOST), F.lit("/people/"), F.col("urlToken"), F.lit("/following")).alias("url"),
        body.alias("body"))


def api_follow_pages(t: Tables) -> DataFrame:
    """(url, body): follow-list API pages, one per follow document, as JSON text.

    The element of line 3 of each order lacks its name (skipped by the parser).
    """
    rows = paged_follow_rows(t)
    item = F.struct(
        F.col("l_linenumber").alias("pos"),
        F.col("l_suppkey").alias("supp"),
        F.col("l_partkey").alias("part"),
        token("l_suppkey").alias("url_token"),
        F.concat(F.lit(HOST), F.lit("/people/"), token("l_suppkey")).alias("url"),
        F.when(F.col("l_linenumber") == 3, F.lit(None))
         .otherwise(F.concat(F.lit("User#"), F.col("l_suppkey").cast("string"))).alias("name"),
        (F.col("l_suppkey") % 3 - 1).cast("int").alias("gender"),
    )
    docs = (rows.groupBy("o_custkey", "l_orderkey", "page")
            .agg(F.array_sort(F.collect_list(item)).alias("items")))
    data = F.transform("items", lambda x: x.dropFields("pos", "supp", "part"))
    # a page of every seventh order does not say whether it is the last one
    ends = F.when(F.col("l_orderkey") % 7 != 3, F.struct(F.lit(True).alias("is_end")))
    body = F.to_json(F.struct(ends.alias("paging"), data.alias("data")))
    url = F.concat(F.lit(HOST), F.lit("/api/v4/members/"), token("o_custkey"),
                   F.lit("/followees?include=data&offset="), (F.col("page") * PAGE_SIZE).cast("string"),
                   F.lit("&limit="), F.lit(str(PAGE_SIZE)))
    return docs.select(url.alias("url"), body.alias("body"))


def link_pages(t: Tables) -> DataFrame:
    """(page_id, url, html): the pages, their anchors written in six ordinary ways by residue class of the page.

    The links and their texts stay what they are; every ninth page links to people instead, and every tenth writes its links
    with dot segments, a ``>`` in an attribute and character references, beside anchors in a comment and a script."""
    k = F.col("page_id")
    people = F.when(k % 9 == 4, F.regexp_replace("html", '<a href="/', '<a href="/people/')).otherwise(F.col("html"))
    html = (F.when(k % 5 == 1, F.regexp_replace(people, '<a href="', '<a class="x" data-n=1 href="'))
            .when(k % 5 == 2, F.regexp_replace(people, '<a href="([^"\']*)"', "<a href='$1' rel=nofollow"))
            .when(k % 5 == 3, F.regexp_replace(people, '<a href="([^"]*)">([^<]*)</a>', '<A\nHREF = "$1">$2</A >'))
            .when(k % 5 == 4, F.regexp_replace(people, '<a href="([^"]*)">([^<]*)</a>', '<a href="$1"><b>$2</b></a>'))
            .when(k % 10 == 5, F.concat(
                F.lit("""<!-- <a href="/no">no</a> --><script>var a = "<a href='/no'>no</a>";</script>"""),
                F.regexp_replace(F.regexp_replace(people, '<a href="/', '<a title="a>b" href="../x/../'), "</a>", " &amp; &eacute;&#xe9;</a>")))
            .otherwise(people))
    return t.pages.select("page_id", "url", html.alias("html"))


def crawl_urls(t: Tables) -> DataFrame:
    """(url): the pages' own URLs, one profile URL per customer and one
    follow-API URL per follow document."""
    profile = t.customer.select(
        F.concat(F.lit(HOST), F.lit("/people/"), token("c_custkey"), F.lit("/following")).alias("url"))
    docs = paged_follow_rows(t).select("o_custkey", "l_orderkey", "page").distinct()
    api = docs.select(F.concat(
        F.lit(HOST), F.lit("/api/v4/members/"), token("o_custkey"),
        F.lit("/followees?include=data&offset="), (F.col("page") * PAGE_SIZE).cast("string"),
        F.lit("&limit="), F.lit(str(PAGE_SIZE))).alias("url"))
    return t.pages.select("url").unionByName(profile).unionByName(api)
