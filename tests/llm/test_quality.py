import re
from collections import Counter

from pyspark.sql import functions as F

from asklens.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), len(lines),
            n < 50 or 100 * len(hit) > 50 * n)


def test_measures(docs, odd, none):
    for df in (docs, odd):
        got = quality.quality_rules(df).select("doc_id", *quality.MEASURES, "base_failed").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(((r["doc_id"], *brute(r["text"])) for r in df.collect()), key=repr)
    assert quality.quality_rules(none).count() == 0


def hosts(spark, rates):
    rows = [(h, i < f) for h, (n, f) in rates.items() for i in range(n)]
    return spark.createDataFrame(rows, "host string, failed boolean")


def test_prior_shrinks_small_hosts(spark):
    rates = {f"h{k}": (200, 20 + k) for k in range(12)} | {"small": (2, 2), "bad": (500, 450), None: (300, 10)}
    got = {r["host"]: r for r in quality.host_verdicts(hosts(spark, rates)).collect()}
    n, f = (sum(x[i] for x in rates.values()) for i in (0, 1))
    m = f / n
    v = sum(b * b / a for a, b in rates.values()) / n - m * m
    s = min(1000, max(1, m * (1 - m) / v - 1))
    for h, (a, b) in rates.items():
        assert abs(got[h]["host_rate"] - (b + m * s) / (a + s)) < 1e-9
    assert got["bad"]["host_rate"] > 0.8 and got["h0"]["host_rate"] < 0.2 and got["small"]["host_rate"] < 1


def test_all_alike_and_all_bad(spark):
    same = quality.host_verdicts(hosts(spark, {"a": (10, 0), "b": (10, 0)})).collect()
    assert all(r["host_rate"] == 0 for r in same)
    assert all(r["host_rate"] == 1 for r in quality.host_verdicts(hosts(spark, {"a": (10, 10)})).collect())


def test_verdicts_reach_documents(spark):
    clean = " ".join(f"plain{i} word" for i in range(60))
    noisy = clean + " ### $$$ %%% &&& *** ### $$$ %%% &&& *** ### $$$"
    noisy += " ||| <<< >>> ||| ### ### ###"
    df = spark.range(0, 400, 1, 4).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 100, "bad").otherwise(F.concat(F.lit("good"), F.col("id") % 3)).alias("source"),
        F.when((F.col("id") % 100 < 90) & (F.col("id") < 100) | (F.col("id") == 200), noisy).otherwise(clean).alias("text"))
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(df).collect()}
    assert not any(got[i] for i in range(90)), "failures on the bad host go"
    assert all(got[i] for i in range(90, 400)), "clean documents stay, and so does a failure on a good host"
    assert quality.drop_rejected(df).count() == 310


def test_drop_rejected_keeps_columns(odd, none):
    left = quality.drop_rejected(odd)
    assert left.columns == odd.columns
    assert left.count() == quality.quality_rules(odd).where("kept").count()
    assert quality.drop_rejected(none).count() == 0


def verdicts(rows):
    """kept of every (source, text) by the rules in plain Python."""
    found, per_host = [], {}
    for source, text in rows:
        n, chars, symbols, dup, repeat, lines, base = brute(text)
        excess = [repeat / (0.3 * n) if n else 0, symbols / (0.1 * n) if n else 0, dup / (0.3 * lines) if lines else 0,
                  2 * n / chars if chars else 0, chars / (15 * n) if n else 0]
        failed = n < 50 or 10 * repeat > 3 * n or 10 * symbols > n or 10 * dup > 3 * lines or chars < 2 * n or chars > 15 * n
        found.append((source, base, failed, max(excess)))
        count = per_host.setdefault(source, [0, 0])
        count[0] += 1
        count[1] += failed
    total, bad = (sum(c[i] for c in per_host.values()) for i in (0, 1))
    m = bad / total
    v = sum(f * f / n for n, f in per_host.values()) / total - m * m
    s = 1000.0 if v * 1001 <= m * (1 - m) else 1.0 if v * 2 >= m * (1 - m) else m * (1 - m) / v - 1
    rate = {h: (f + m * s) / (n + s) for h, (n, f) in per_host.items()}
    return [not base and not (failed and rate[h] * excess > 1 - rate[h]) for h, base, failed, excess in found]


def test_verdict_decides_on_given_tables(spark):
    """The host verdict against plain Python, and it removes what the hard rule leaves."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = df.collect()
    want = dict(zip([r["doc_id"] for r in rows], verdicts([(r["source"], r["text"]) for r in rows])))
    got = {r["doc_id"]: r for r in quality.quality_rules(df).collect()}
    assert {d: r["kept"] for d, r in got.items()} == want
    assert sum(not r["base_failed"] and not r["kept"] for r in got.values()) > 20
    assert all(r["kept"] for r in got.values() if not r["failed"])


def test_one_text_on_a_good_and_a_bad_host(spark):
    clean = " ".join(f"plain{i} word" for i in range(60))
    mild = clean + " #" * 20                                      # 1.4 times the limit of symbols
    gross = " ".join(w + "#" * 12 for w in clean.split())         # 120 times
    rows = [(i, "good", clean) for i in range(95)] + [(100, "good", mild), (101, "good", gross)]
    rows += [(200 + i, "bad", mild) for i in range(80)] + [(300 + i, "bad", clean) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(df).collect()}
    assert got[100] and not got[101] and not any(got[200 + i] for i in range(80))
    assert all(got[i] for i in [*range(95), *range(300, 320)])
    left = {r["doc_id"] for r in quality.drop_rejected(df).collect()}
    assert left == {d for d, kept in got.items() if kept}
