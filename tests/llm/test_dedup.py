import hashlib
import re

from pyspark.sql import functions as F

from asklens.llm import exact_dedup
from asklens.llm.common import HOT_SHARE, join_groups, written

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(SPACE.sub(" ", text or ""), []).append(doc)
    out = []
    for norm, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        keep = known[0] if known else None
        sha = hashlib.sha256(norm.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            out.append((i, keep, len(ids), first, sha))
            first = False
    return sorted(out, key=repr)


def found(df, **options):
    got = exact_dedup.exact_dedup(df, **options).select("doc_id", "keep_id", "group_size", "kept", "digest").collect()
    return sorted((tuple(r) for r in got), key=repr)


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_against_brute_force(docs, odd, none):
    assert found(docs) == brute(texts(docs))
    assert found(odd) == brute(texts(odd))
    assert found(none) == []


def test_weak_digest_never_merges_different_texts(docs):
    """With a digest of one hex letter, groups are the same: texts are compared in full."""
    weak = found(docs, digest=lambda t: F.substr(F.sha2(t, 256), F.lit(1), F.lit(1)))
    assert [x[:4] for x in weak] == [x[:4] for x in sorted(found(docs), key=lambda x: repr((*x[:4], x[4][:1])))]


def test_hot_group_over_many_partitions(spark):
    df = spark.range(0, 3000, 1, 40).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot  copy").otherwise(
        F.concat(F.lit("text "), "id")).alias("text"))
    assert found(df) == brute(texts(df))
    drops = exact_dedup.drop_copies(df)
    assert drops.count() == 2001 and drops.where("text = 'hot  copy'").first()["doc_id"] == 0


def test_drop_copies_keeps_columns(odd, none):
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns
    assert left.count() == len({SPACE.sub(" ", t or "") for _, t in texts(odd)})
    assert exact_dedup.drop_copies(none).count() == 0


def test_join_groups_is_a_plain_join(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    groups = written(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k IS NULL OR k % 2 = 0"), "t")
    got = {tuple(r) for r in join_groups(rows, groups, ["k"], "n").collect()}
    size = {r["k"]: r["n"] for r in groups.collect()}
    assert got == {(r["k"], r["v"], size[r["k"]]) for r in rows.collect() if r["k"] in size}
    left = join_groups(rows, groups, ["k"], "n", "left")
    assert left.count() == 5000 and left.where("n IS NULL").count() == 5000 - len(got)
    assert HOT_SHARE == 1000
