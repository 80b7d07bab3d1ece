import hashlib
import random
import re

from asklens.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    out = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        out += x - 9 * (x > 9)
    return out % 10 == 0


def fits(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": all(int(x) <= 255 for x in value.split(".")) if kind == "ip" else False,
            "card": 12 <= len(digits) <= 19 and luhn(digits or "1"), "phone": 9 <= len(digits) <= 15}[kind]


def brute(text):
    spans = sorted((m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(PATTERNS.items())
                   for m in re.finditer(p, text or "") if fits(kind, m.group()))
    counts = [sum(s[2] == kind for s in spans) for kind in PATTERNS]
    return counts, ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)


def check(df):
    got = pii.pii_report(pii.find_personal_data(df)).collect()
    want = sorted(((r["doc_id"], *brute(r["text"])[0], hashlib.sha256(brute(r["text"])[1].encode()).hexdigest())
                   for r in df.collect()), key=repr)
    assert sorted((tuple(r)[:6] for r in got), key=repr) == want
    return got


def test_base_spans(docs, odd, none):
    check(docs)
    check(odd)
    assert check(none) == []


def test_made_up_texts(spark):
    rng = random.Random(7)
    parts = ["a.b@c.de", "@", "x@y", "a@b.c_d@e.f.g", "é@ü.com", "1.2.3.4", "1.2.3", "0255.1.2.3", "256.1.1.1", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "4111  1111", "+1 (310) 555-4510", "+49.", "+1 2", "++12345678901", "123456789012345678901234", " ", "",
             "12", "-", ".", "🙂", "\n", "378282246310005", "name", "+1-2-3-4-5-6-7-8-9x"]
    texts = [(i, "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(14)))) for i in range(400)]
    check(spark.createDataFrame(texts, "doc_id bigint, text string"))


def test_long_runs_end(spark):
    """Runs that a plain pattern would scan again from every place (so no brute force here)."""
    texts = [(1, "1" * 200_000), (2, "a" * 200_000 + "@"), (3, "1 " * 100_000), (4, "+1" + "2" * 100_000 + "x"),
             (5, "1.2.3.4 " * 300), (6, "a@" + "b." * 50_000), (7, "a@" + "b" * 100_000 + ".c")]
    got = {r["doc_id"]: r for r in pii.pii_report(pii.find_personal_data(spark.createDataFrame(texts, "doc_id bigint, text string"))).collect()}
    assert got[5]["n_ip"] == 300 and got[6]["n_email"] == got[7]["n_email"] == 1
    assert got[7]["spans"] == "email:0:100004" and [got[i]["spans"] for i in (1, 2, 3, 4)] == [""] * 4


def test_votes_decide_on_looser_spans(spark):
    """Phone numbers without a country code, with words that speak for them, are added; numbers that fail their checks are not."""
    rows = [(i, f"please call +1 (310) 555-{1000 + i} today") for i in range(60)]
    rows += [(100 + i, f"please call (310) 555-{1000 + i} today") for i in range(30)]
    rows += [(200 + i, f"order no 4111 1111 1111 {2000 + i} x99.300.1.{i} here") for i in range(60)]
    got = {r["doc_id"]: r["spans"] for r in pii.pii_report(pii.find_personal_data(
        spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()}
    assert all(got[i].startswith("phone:12:") for i in range(60))
    assert all(got[100 + i] == "phone:12:26" for i in range(30))
    base = {i: brute(t)[1] for i, t in rows}
    assert all(got[200 + i] == base[200 + i] for i in range(60))


def test_plain_text_has_no_spans(spark):
    df = spark.createDataFrame([(1, "Nothing to see in version 1.2.3 of 2024-01-01, page 12."), (2, "a (at) b")], "doc_id bigint, text string")
    assert [r["spans"] for r in pii.pii_report(pii.find_personal_data(df)).collect()] == ["", ""]
