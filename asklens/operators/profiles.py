"""Parsing of crawled pages into records.

The reference parses one HTTP response at a time inside the crawler; here
a column of page bodies is parsed by JSON and regex expressions, one pass,
partitioned like the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asklens.functions import text as X
from asklens.schemas import API_PAGE_SCHEMA, PROFILE_COUNTERS, PROFILE_SCALAR_KEYS, RAW_PROFILE_SCHEMA

# the script element with that id, whatever its other attributes; its text may span lines
SCRIPT = r"""(?is)<script\b(?=[^>]*\sid\s*=\s*["']?js-initialData["'\s>])[^>]*>(.*?)</script>"""
INITIAL_DATA = T.StructType([T.StructField("initialState", T.StructType([
    T.StructField("entities", T.StructType([
        T.StructField("users", T.MapType(T.StringType(), T.StringType()))]))]))])


def embedded_user_json(pages: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """(urlToken, json): the user object of a profile page, picked by the token in its URL.
    Pages without the script or without that user give a null json."""
    data = F.from_json(F.regexp_extract(F.col(body), SCRIPT, 1), INITIAL_DATA)
    tok = X.url_token(F.col(url))
    return pages.select(tok.alias("urlToken"),
                        F.element_at(data["initialState"]["entities"]["users"], tok).alias("json"))


REQUIRED_KEYS = PROFILE_SCALAR_KEYS + ["business", "locations", "educations"]
# as RAW_PROFILE_SCHEMA, but business keeps its keys: one without a name is not one whose name is null
_PARSED = T.StructType([T.StructField("business", T.MapType(T.StringType(), T.StringType())) if f.name == "business" else f
                        for f in RAW_PROFILE_SCHEMA])
# what tells a readable record from another
_CHECKED = T.StructType([f for f in _PARSED if f.name in ("business", "description", "locations", "educations")])


def _parsed(raw: DataFrame, json: str, schema: T.StructType) -> DataFrame:
    """Adds ``_u``, the record by ``schema``, and ``_keys``, its keys.  A record is parsed once for each: what the generator
    makes is a column, so a later filter on it is not pushed below and parsed again."""
    record = F.struct(F.from_json(F.col(json), schema).alias("u"), F.json_object_keys(F.col(json)).alias("keys"))
    rows = raw.select("*", F.explode(F.array(record)).alias("_r"))
    return rows.select(*raw.columns, F.col("_r.u").alias("_u"), F.col("_r.keys").alias("_keys"))


def _readable() -> Column:
    """Whether the flattener can read ``_u``: every key is there, business holds a name, and no value it needs is unusable: a
    null description (tag stripping needs text), null locations or educations (they
    are iterated), or a kept education whose school or major has no name."""
    u = F.col("_u")
    whole = F.size(F.array_except(F.array(*[F.lit(k) for k in REQUIRED_KEYS]), F.col("_keys"))) == 0
    kept = F.filter(u["educations"], lambda e: e["school"].isNotNull() & e["major"].isNotNull())
    nameless = F.exists(kept, lambda e: e["school"]["name"].isNull() | e["major"]["name"].isNull())
    ok = (whole & F.map_contains_key(u["business"], F.lit("name")) & u["description"].isNotNull() & u["locations"].isNotNull()
          & u["educations"].isNotNull() & ~F.coalesce(nameless, F.lit(False)))
    return F.coalesce(ok, F.lit(False))


def quarantine(raw: DataFrame, json: str = "json") -> DataFrame:
    """Adds ``status``: 'ok', or 'ERROR' when the flattener would fail on the record:
    a key it reads is absent or a value it reads is unusable (one failure sends the
    whole record to the error side, B12)."""
    status = F.when(_readable(), "ok").otherwise("ERROR").alias("status")
    return _parsed(raw, json, _CHECKED).select(*raw.columns, status)


def flatten_profile(raw: DataFrame, json: str = "json") -> DataFrame:
    """Valid raw user objects -> the 34 profile fields.

    ``headline`` loses its newlines, ``description`` its tags, ``business`` is
    its name, ``locations`` keeps named elements, ``educations`` keeps elements
    that have both a school and a major.
    """
    p = _parsed(raw.select(json), json, _PARSED).where(_readable()).select(F.col("_u").alias("u"))
    locs = F.transform(F.filter("u.locations", lambda x: x["name"].isNotNull()), lambda x: x["name"])
    edus = F.transform(
        F.filter("u.educations", lambda e: e["school"].isNotNull() & e["major"].isNotNull()),
        lambda e: F.struct(e["school"]["name"].alias("school"), e["major"]["name"].alias("major")))
    return p.select(
        F.col("u.id").alias("id"), F.col("u.urlToken").alias("urlToken"), F.col("u.name").alias("name"),
        F.col("u.isOrg").alias("isOrg"), F.col("u.type").alias("type"), F.col("u.url").alias("url"),
        X.drop_newlines(F.coalesce(F.col("u.headline"), F.lit("None"))).alias("headline"),  # str(None)
        F.col("u.isActive").alias("isActive"),
        X.strip_tags(F.col("u.description")).alias("description"),
        F.col("u.gender").alias("gender"), F.col("u.badge").alias("badge"),
        *[F.col(f"u.{c}").alias(c) for c in PROFILE_COUNTERS],
        F.col("u.business")["name"].alias("business"),
        locs.alias("locations"), edus.alias("educations"))


def api_follows(pages: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """Follow-list API pages -> (user, id, url, name, gender), one row per complete
    element; an element lacking any key is skipped on its own, a page that does not say whether
    it is the last one (``paging.is_end``) gives nothing (H19)."""
    parsed = pages.select(X.url_token(F.col(url)).alias("user"),
                          F.from_json(F.col(body), API_PAGE_SCHEMA).alias("p")).where("p.paging.is_end IS NOT NULL")
    rows = parsed.select("user", F.explode("p.data").alias("d"))
    out = rows.select("user", F.col("d.url_token").alias("id"), F.col("d.url").alias("url"),
                      F.col("d.name").alias("name"), F.col("d.gender").alias("gender"))
    return out.where(F.col("id").isNotNull() & F.col("url").isNotNull()
                     & F.col("name").isNotNull() & F.col("gender").isNotNull())


def page_links(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, pos, href, text, abs_url, id, gender) of every named anchor of a page (H18, H20): id is what
    follows ``/people/`` in the link (null otherwise); a page does not tell the gender, so it is -1."""
    rows = pages.select(key, url, F.posexplode(X.anchors(F.col(html))).alias("pos", "a"))
    return (rows.where(F.col("a.text") != "")
            .select(key, "pos", F.col("a.href").alias("href"), F.col("a.text").alias("text"),
                    X.absolute_url(F.col("a.href"), F.col(url)).alias("abs_url"),
                    F.nullif(F.regexp_extract(F.col("a.href"), "/people/([^/?#]+)", 1), F.lit("")).alias("id"),
                    F.lit(-1).alias("gender")))


def profile_ledger(raw: DataFrame, token: str = "urlToken", json: str = "json") -> DataFrame:
    """The profile job's ledger lines (value): the id of a record that could be read, ``id:::ERROR`` of another."""
    status = quarantine(raw, json)
    return status.select(F.when(F.col("status") == "ok", F.col(token))
                         .otherwise(F.concat(F.col(token), F.lit(X.KV_SEP + "ERROR"))).alias("value"))
