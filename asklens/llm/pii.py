"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans come from strict formats (the base: always kept) and from looser ones (numbers that fail a check,
phone numbers without a country code, addresses with "(at)").  Labelers vote on each candidate, for, against or
abstaining: its format, its checksum or ranges, gazetteers (top-level domains, card prefixes, country codes, reserved networks), the words
before it and the characters around it.  Votes are counted by pattern over the whole corpus; expectation
maximisation estimates from the counts how reliable each labeler is for each kind, with base spans known to be
right.  Its soft labels train the final classifier, naive Bayes over the surface of the spans.  A looser span is
reported if the votes and the classifier both find it more likely right than not, and it touches no span kept so far.

Nothing but patterns and model weights ever leaves the tables, a few hundred numbers whatever the corpus.

Defined cases: a null or empty text has no spans; repeated rows and null ids are scanned like any other; without candidates the
model stays at its priors; extra columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asklens.llm.common import let, match_spans, written

KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"

# The base formats.  A run of characters that a format starts with is entered at its start only (or where the
# last match ended): from inside the run it would end the same way, so the matches are the plain pattern's, in linear time.
FORMATS = {
    EMAIL: (r"(?:\G|(?<!" + LOCAL + "))" + LOCAL + "++@" + LABEL + r"++(?:\." + LABEL + "++)++", "@"),
    IP: (r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", "."),
    CARD: (r"[0-9](?:[\x20-]?[0-9]){11,}+", None),
    PHONE: (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
# Looser formats: kind, pattern, what the text must hold
_AT, _DOT = r"(?:\x20?[\[(]at[\])]\x20?)", r"(?:\.|\x20?[\[(]dot[\])]\x20?)"
LOOSE = [
    (EMAIL, r"(?:\G|(?<!" + LOCAL + "))" + LOCAL + "++" + _AT + LABEL + "++(?:" + _DOT + LABEL + "++)++", "at"),
    (PHONE, r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9])", None),
]

# Gazetteers and context words: fixed values
TLDS = ["com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "it", "nl", "eu", "ch", "at", "be", "us", "ca", "au", "jp"]
CARD_PREFIX = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|62)"
COUNTRY_CODE = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RESERVED_NETWORK = r"^0*(?:0|127|255)\."
BEFORE = 24
FOR_WORDS = {
    EMAIL: "e-?mail|contact|write|address|reach",
    IP: r"\bip\b|host|server|client|login|address",
    CARD: "card|visa|master|credit|debit|pay",
    PHONE: r"phone|\btel|call|fax|mobile|cell|dial",
}
AGAINST_WORDS = {
    EMAIL: r"example of|pattern",
    IP: r"version|\bv\.?$|release|section|chapter|build",
    CARD: r"order|isbn|serial|\bid\b|invoice|part no|hash",
    PHONE: r"version|isbn|equation|order",
}
LABELERS = ["format", "check", "gazetteer", "words", "edges"]
FEATURES = ["length", "digits", "marks", "first", "before", "after"]
ROUNDS = 12
SMOOTH = 1.0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    doubled = lambda x: F.when(x > 4, x * 2 - 9).otherwise(x * 2)

    def add(total, i):
        x = F.substr(digits, n - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, doubled(x)).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def passes(kind: int, value: Column) -> Column:
    """The check a base match must pass."""
    if kind == EMAIL:
        return F.lit(True)
    if kind == IP:
        part = lambda p: let(F.regexp_replace(p, "^0+(?=[0-9])", ""),
                             lambda x: F.when(F.length(x) <= 3, x.cast("int") <= 255).otherwise(F.lit(False)))
        return F.forall(F.split(value, r"\."), part)
    digits = _digits(value)
    if kind == PHONE:
        return F.length(digits).between(9, 15)
    return let(digits, lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False)))


def _gated(text: Column, pattern: str, needs: str | None) -> Column:
    held = F.contains(text, F.lit(needs)) if needs else text.rlike("[0-9]")
    return F.when(held, match_spans(text, pattern)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))


def _candidate(kind: int, span: Column, text: Column, base: Column, loose: bool) -> Column:
    value, start, end = span["value"], span["start"], span["end"]
    before = F.lower(F.substr(text, F.greatest(start - BEFORE + 1, F.lit(1)), F.least(start, F.lit(BEFORE))))
    left = F.when(start > 0, F.substr(text, start, F.lit(1))).otherwise(F.lit(" "))
    right = F.substr(text, end + 1, F.lit(1))
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    fits = F.lit(True) if loose else base
    if kind == EMAIL:
        domain = F.substring_index(F.lower(value), ".", -1)
        check, gazetteer = vote(domain.rlike("^[a-z]{2,}$"), F.lit(True)), vote(domain.isin(TLDS), F.lit(False))
    elif kind == IP:
        check, gazetteer = vote(base, ~base), vote(F.lit(False), value.rlike(RESERVED_NETWORK))
    elif kind == CARD:
        check, gazetteer = vote(base, ~base), vote(value.rlike(CARD_PREFIX), F.lit(True))
    else:
        n = F.length(_digits(value))
        check, gazetteer = vote(n.between(9, 15), F.lit(True)), vote(value.rlike(COUNTRY_CODE), F.lit(False))
    word = r"[\p{L}\p{N}]"
    edges = vote(~left.rlike(word) & ~right.rlike(word), F.lit(True))
    votes = [vote(fits, ~fits), check, gazetteer, vote(before.rlike(FOR_WORDS[kind]), before.rlike(AGAINST_WORDS[kind])), edges]
    n_digits = F.length(_digits(value))
    shape = lambda c: (F.when(c.rlike(r"^\p{L}"), "letter").when(c.rlike("^[0-9]"), "digit")
                       .when(c.rlike(r"^\s") | (c == ""), "space").otherwise("mark"))
    features = [F.least((end - start) / 4, F.lit(8)).cast("int").cast("string"),
                F.least(n_digits * 5 / (end - start), F.lit(5)).cast("int").cast("string"),
                F.least(F.length(F.regexp_replace(value, r"[\p{L}\p{N}]", "")), F.lit(6)).cast("string"),
                shape(value), shape(left), shape(right)]
    return F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), base.alias("base"),
                    F.array(*[v.cast("int") for v in votes]).alias("votes"), F.array(*features).alias("features"))


def candidates(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``spans``: every candidate with kind, base, votes and features."""
    slim = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    text = F.col("__text")

    def seen(kind, pattern, needs, loose):
        return F.transform(_gated(text, pattern, needs), lambda s: _candidate(
            kind, s, text, F.lit(False) if loose else passes(kind, s["value"]), loose))

    parts = [seen(k, p, needs, False) for k, (p, needs) in FORMATS.items()] + [seen(k, p, needs, True) for k, p, needs in LOOSE]
    return slim.select(*keep, F.concat(*parts).alias("spans"))


def _log_ratio(yes: float, no: float, yes_all: float, no_all: float, values: int) -> float:
    return math.log((yes + SMOOTH) / (yes_all + SMOOTH * values)) - math.log((no + SMOOTH) / (no_all + SMOOTH * values))


def _weighted(weights: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in sorted(weights.items()) for x in kv])


def _evidence(weights: Column, kind: Column, values: Column, n: int) -> Column:
    """Log odds of the prior and of each value at its place."""
    one = lambda i: F.coalesce(F.try_element_at(weights, F.concat_ws("|", kind, F.lit(i), F.get(values, i))), F.lit(0.0))
    out = F.coalesce(F.try_element_at(weights, F.concat_ws("|", kind, F.lit("prior"))), F.lit(0.0))
    for i in range(n):
        out = out + one(i)
    return out


def _model(counted: DataFrame, n: int, weight: Column, values: int) -> dict[str, float]:
    """Log-odds weights from ``counted(kind, values, n)`` with the soft label ``weight``: 2 sums per kind, place and value."""
    cells = counted.select("kind", (F.col("n") * weight).alias("yes"), (F.col("n") * (1 - weight)).alias("no"),
                           F.posexplode(F.col("values").cast("array<string>")).alias("place", "value"))
    sums = cells.groupBy("kind", "place", "value").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).collect()
    totals: dict[int, list[float]] = {}
    for r in sums:
        if r["place"] == 0:
            t = totals.setdefault(r["kind"], [0.0, 0.0])
            t[0] += r["yes"]
            t[1] += r["no"]
    out = {f"{k}|prior": math.log((y + SMOOTH) / (no + SMOOTH)) for k, (y, no) in totals.items()}
    for r in sums:
        y, no = totals[r["kind"]]
        out[f"{r['kind']}|{r['place']}|{r['value']}"] = _log_ratio(r["yes"], r["no"], y, no, values)
    return out


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def train(spans: DataFrame, rounds: int = ROUNDS) -> tuple[dict[str, float], dict[str, float]]:
    """(labeler weights, classifier weights) from ``spans(kind, base, votes, features)``, all of them."""
    n_votes = len(LABELERS)
    # at most 2 x kinds x 3 ^ labelers patterns
    patterns = written(spans.groupBy("kind", "base", F.col("votes").alias("values")).agg(F.count(F.lit(1)).alias("n")), "patterns")
    majority = F.aggregate("values", F.lit(0.0), lambda a, v: a + v)
    votes: dict[str, float] = {}
    for k in range(rounds):
        belief = _sigmoid(_evidence(_weighted(votes), F.col("kind"), F.col("values"), n_votes)) if votes else _sigmoid(majority)
        votes_next = _model(patterns, n_votes, F.when(F.col("base"), F.lit(1.0)).otherwise(belief), 3)
        settled = votes and max(abs(votes_next[x] - votes[x]) for x in votes_next) < 1e-4
        votes = votes_next
        if settled or not votes:
            break
    if not votes:
        return {}, {}
    soft = F.when(F.col("base"), F.lit(1.0)).otherwise(_sigmoid(_evidence(_weighted(votes), F.col("kind"), F.col("votes"), n_votes)))
    surfaces = spans.groupBy("kind", "base", "votes", F.col("features").alias("values")).agg(F.count(F.lit(1)).alias("n"))
    return votes, _model(surfaces, len(FEATURES), soft, 8)


def find_personal_data(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, base (spans of the base formats) and spans (those and the accepted looser ones), both as
    arrays of (start, kind, end) in order."""
    found = written(candidates(docs, text_col, keep), "candidates")
    rows = found.select(F.explode("spans").alias("s")).select("s.kind", "s.base", "s.votes", "s.features")
    votes, surface = train(rows)
    plain = lambda spans: F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    base = F.filter("spans", lambda s: s["base"])
    if votes:
        likely = lambda s: ((_evidence(_weighted(votes), s["kind"], s["votes"], len(LABELERS)) > 0)
                            & (_evidence(_weighted(surface), s["kind"], s["features"], len(FEATURES)) > 0))
        extra = let(base, lambda b: F.filter("spans", lambda s: ~s["base"] & likely(s) & ~F.exists(
            b, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]))))
        more = plain(extra)
    else:
        more = none
    out = found.select(*keep, plain(base).alias("base"), more.alias("__more"))
    # of two looser spans that overlap, the one that starts first (then the first kind) stays
    apart = F.aggregate("__more", F.struct(F.lit(0).alias("at"), none.alias("out")), lambda acc, s: F.when(
        s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(s)).alias("out"))).otherwise(acc),
        lambda acc: acc["out"])
    return out.select(*keep, "base", F.array_sort(F.concat("base", apart)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def pii_report(found: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Digest columns: n_email, n_ip, n_card, n_phone (base), base_sha256, spans."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(*keep, *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
                        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
