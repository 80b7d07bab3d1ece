"""The pipeline's stages against brute force over the rows that each got, and the whole run."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from asklens.llm import mixing, quality
from asklens.llm.common import written
from tests.llm.test_dedup import SPACE
from tests.llm.test_mixing import check as check_mix
from tests.llm.test_quality import brute as measures
from tests.llm.test_simhash import brute_components, brute_fp
from tests.llm.test_tokens_and_packing import ids_of

SF = "/root/testdata/sf0.001"


def listed(df):
    return sorted(map(tuple, df.collect()), key=repr)


def stages(spark, docs):
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, written(stage(spark, out[-1][1], SF), f"test-{name}")))
    return out


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_stages(spark, which, request, byte_file):
    docs = request.getfixturevalue(which)
    (_, before), (_, good), (_, once), (_, apart), (_, mix), (_, packed) = stages(spark, docs)
    for df in (good, once, apart, mix):
        assert df.columns == docs.columns
    # quality: the hard rule's failures go, no document that breaks no rule does
    passing = [r for r in before.collect() if not measures(r["text"])[-1]]
    clean = {r["doc_id"] for r in quality.quality_rules(before).where("NOT failed").collect()}
    assert {r["doc_id"] for r in good.collect()} >= clean
    assert all(x in [tuple(r) for r in passing] for x in listed(good))
    # exact dedup: one row of each text, the one with the smallest id
    least = {}
    for r in good.collect():
        least.setdefault(SPACE.sub(" ", r["text"] or ""), []).append(r["doc_id"])
    known = {t: min((i for i in ids if i is not None), default=None) for t, ids in least.items()}
    assert sorted(((SPACE.sub(" ", r["text"] or ""), r["doc_id"]) for r in once.collect()), key=repr) == sorted(known.items(), key=repr)
    # near-dedup: one row of each component, the one with the smallest id
    rows = once.collect()
    label = brute_components([brute_fp(r["text"]) for r in rows]) if rows else np.array([])
    first = {}
    for r, c in zip(rows, label):
        first.setdefault(c, []).append((r["doc_id"] is None, r["doc_id"] or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in apart.collect()) == sorted(min(v) for v in first.values())
    # mixing: the words that the operator takes
    taken = {r["doc_id"]: r["taken"] for r in check_mix(apart)}
    words = {}
    for r in mix.select("doc_id", mixing.n_words(F.col("text")).alias("n")).collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + r["n"]
    assert words == {d: n for d, n in taken.items() if n}
    # packing: all ids of all rows, once
    want = sum(len(ids_of(byte_file, r["text"], 0)) // 4 for r in mix.collect())
    assert packed.agg(F.sum("length")).first()[0] == (want or None)


def test_run_and_empty(spark, none, tmp_path):
    assert corpus_pipeline.run(spark, SF).count() > 0
    none.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert [re.sub(r"\W", "", n) for n, _ in corpus_pipeline.STAGES] == [n for n, _ in corpus_pipeline.STAGES]


def test_a_column_named_like_the_files_metadata(spark, tmp_path):
    """Tables that hold columns of Spark's own hidden names, read from Parquet and not, keep them through every stage."""
    path = f"file:{tmp_path}/parquet/documents.parquet"
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.withColumns({"_metadata": F.concat(F.lit("m"), F.col("doc_id").cast("string")), "file_path": F.lit("x"), "row_index": F.lit(1)})
    odd.write.parquet(path)
    plain = {}
    for source in (spark.read.parquet(path), odd.repartition(3), docs):
        kept = source
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = kept
            kept = written(stage(spark, before, SF), f"test-meta-{name}")
            assert kept.columns == source.columns
            ids = sorted(r["doc_id"] for r in kept.select("doc_id").collect())
            assert plain.setdefault(name, ids) == ids
        if "_metadata" in kept.columns:
            assert all(r["_metadata"] == f"m{r['doc_id']}" for r in kept.collect())
