import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from asklens.llm import language_id as lid


def run(df):
    df = df.withColumn("held", lid.held_out(F.col("doc_id")))
    model = lid.train(df.where("NOT held"))
    return lid.predict(df, model, keep=("doc_id", "held", "lang", "text")).collect()


def test_held_out_accuracy(spark, docs):
    got = run(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    out = [r for r in got if r["held"]]
    assert len(out) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.97
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_and_empty(spark, odd, none):
    got = run(odd)
    assert len(got) == odd.count()
    for r in got:
        blank = not r["text"] or not any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == blank and (r["score"] == 0) == blank
    assert run(none) == []
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    assert run(unlabelled)[0]["lang_pred"] == "und"


def test_counts_against_brute_force(spark):
    texts = [("en", "abcab"), ("fr", "ÀÉà"), ("en", "ab"), (None, "zzz"), ("fr", None)]
    languages, logp = lid.train(spark.createDataFrame(texts, "lang string, text string"), max_n=2, buckets=1 << 10)
    counts = np.zeros((1 << 10, 2))
    for lang, text in texts:
        if lang and text:
            for n in (1, 2):
                for i in range(len(text) - n + 1):
                    *_, h = lid.gram_buckets(text[i:i + n], n, 1 << 10)
                    counts[h[-1], languages.index(lang)] += 1
    want = np.log(counts + lid.ALPHA) - np.log(counts.sum(axis=0) + lid.ALPHA * (1 << 10))
    assert languages == ["en", "fr"] and np.allclose(logp, want, atol=1e-5)
    assert counts.sum() == 9 + 3 + 5


def test_blocks_give_the_same_grams(monkeypatch):
    text = "the quick brown fox" * 20
    whole = sorted(np.concatenate(list(lid.gram_buckets(text))).tolist())
    monkeypatch.setattr(lid, "BLOCK_CHARS", 7)
    assert sorted(np.concatenate(list(lid.gram_buckets(text))).tolist()) == whole


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(lid, "MAX_MODEL_BYTES", 4 * lid.BUCKETS)
    with pytest.raises(ValueError):
        lid.train(spark.createDataFrame([("a", "x"), ("b", "y")], "lang string, text string"))


def test_letters_are_letters(spark):
    """Numbers and signs that look like words have no letter."""
    languages, logp = lid.train(spark.createDataFrame([("en", "some words"), ("fr", "des mots")], "lang string, text string"))
    found, score = lid.score_texts(["½ ²", "①②", "12 ٣ _", "ª", "ʰ漢", "e½"], languages, logp)
    assert found[:3] == ["und"] * 3 and not score[:3].any() and "und" not in found[3:]


def test_letters_that_grow_across_blocks(monkeypatch):
    text = "İstanbul İİ ŞİŞLİ " * 40
    whole = sorted(np.concatenate(list(lid.gram_buckets(text))).tolist())
    for size in (5, 7, 64):
        monkeypatch.setattr(lid, "BLOCK_CHARS", size)
        assert sorted(np.concatenate(list(lid.gram_buckets(text))).tolist()) == whole


@pytest.mark.parametrize("cells", [1, 100, 1 << 21])
def test_scores_against_adding_every_gram(docs, spark, monkeypatch, cells):
    monkeypatch.setattr(lid, "BATCH_CELLS", cells)
    rows = docs.limit(30).collect()
    languages, logp = lid.train(docs)
    texts = [r["text"][:1500] for r in rows] + [None, "", "12 34", "a"]
    found, score = lid.score_texts(texts, languages, logp)
    for text, lang, got in zip(texts, found, score):
        if not text or not any(c.isalpha() for c in text):
            assert (lang, got) == ("und", 0)
            continue
        total = [0.0] * len(languages)
        for h in lid.gram_buckets(text):
            for bucket in h:
                for k in range(len(languages)):
                    total[k] += float(logp[bucket, k])
        gap = [(t - max(total)) * min(len(text), 64) / len(text) for t in total]
        assert lang == languages[int(np.argmax(total))] and got == pytest.approx(1 / np.exp(gap).sum(), rel=1e-3)


def test_many_languages_in_bounded_memory():
    """A thousand languages and a long text: no more than the batch's cells at a time."""
    import tracemalloc

    logp = np.zeros((lid.BUCKETS, 1000), dtype=np.float32)
    tracemalloc.start()
    lid.score_texts(["word " * 60_000 + " ".join(f"w{i}x" for i in range(60_000))], [str(i) for i in range(1000)], logp)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20
