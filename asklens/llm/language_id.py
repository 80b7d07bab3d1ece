"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts the hashed 1- to ``MAX_N``-grams of every labelled text, task by task in numpy, and sums them in Spark by
(language, bucket).  The log-probability matrix (languages x buckets) is what goes to the tasks that score: its
size does not depend on the number of documents, and more than ``MAX_MODEL_BYTES`` is refused.  Scoring is sparse:
a text is its buckets that occur and how often, and the sparse counts of a batch of texts are multiplied by the
matrix together, at most ``BATCH_CELLS`` numbers at a time, however many languages there are and however long a text is.

Defined cases: a text that is null or has no letter is ``und`` with score 0; null labels do not train; without any
training text everything is ``und``; a null id is not held out; repeated rows count as often as they occur;
extra columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asklens.llm.common import map_batches

MAX_N = 3
BUCKETS = 1 << 15
ALPHA = 0.5
BLOCK_CHARS = 1 << 18
MAX_MODEL_BYTES = 256 << 20
UNKNOWN = "und"

BATCH_CELLS = 1 << 21

_LETTER = regex.compile(r"\p{L}")  # the Unicode categories of letters
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def held_out(id_col: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == fold, F.lit(False))


def gram_buckets(text: str, max_n: int = MAX_N, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of the lower-cased text, n from 1 to ``max_n``, in blocks."""
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    text = text.lower()  # before it is cut: lower-casing may change the length
    for at in range(0, len(text), BLOCK_CHARS):
        # a block starts max_n - 1 characters early, so that no n-gram across the cut is lost
        back = min(at, max_n - 1)
        c = np.frombuffer(text[at - back:at + BLOCK_CHARS].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        h = np.zeros(len(c), dtype=np.uint32)
        for n in range(1, max_n + 1):
            h = (h[:len(c) - n + 1] if n > 1 else h) * _MULTIPLIERS[0] + c[n - 1:] + np.uint32(n)
            first = max(0, back - n + 1)  # earlier ones were in the block before
            mixed = (h[first:] ^ (h[first:] >> np.uint32(15))) * _MULTIPLIERS[1]
            if len(mixed):
                yield (mixed ^ (mixed >> np.uint32(13))) * _MULTIPLIERS[2] >> shift


def _counter(languages: list[str], max_n: int, buckets: int):
    place = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), buckets), dtype=np.int64)
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                for h in gram_buckets(text.as_py(), max_n, buckets):
                    counts[place[lang]] += np.bincount(h, minlength=buckets)
        at = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)), pa.array(counts[at])], ["lang_no", "bucket", "n"])

    return run


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", max_n: int = MAX_N,
          buckets: int = BUCKETS, alpha: float = ALPHA) -> tuple[list[str], np.ndarray]:
    """Languages (in order) and their log-probabilities (buckets x languages, float32), from all rows."""
    texts = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL")
    limit = MAX_MODEL_BYTES // (4 * buckets)
    languages = sorted(r["lang"] for r in texts.select("lang").distinct().limit(limit + 1).collect())
    if len(languages) > limit:
        raise ValueError(f"more than {limit} languages: the matrix would exceed {MAX_MODEL_BYTES} bytes")
    counts = np.zeros((buckets, len(languages)))
    if languages:
        parts = map_batches(texts, _counter(languages, max_n, buckets), "lang_no int, bucket int, n bigint")
        # at most languages x buckets rows
        sums = parts.groupBy("lang_no", "bucket").agg(F.sum("n").alias("n")).toPandas()
        counts[sums["bucket"], sums["lang_no"]] = sums["n"]
    logp = np.log(counts + alpha) - np.log(counts.sum(axis=0) + alpha * buckets)
    return languages, logp.astype(np.float32)


def score_texts(texts: list[str | None], languages: list[str], logp: np.ndarray, max_n: int = MAX_N) -> tuple[list[str], np.ndarray]:
    """Language and score of each text.  The score is the posterior of an equal prior, its evidence
    taken as the mean over the text's characters times at most 64 of them, so that long texts do not all read 1.0."""
    total = np.zeros((len(texts), len(languages)))
    blank = np.ones(len(texts), dtype=bool)
    held: list[tuple[int, np.ndarray, np.ndarray]] = []  # text, its buckets, their counts
    size, most = 0, max(1, BATCH_CELLS // max(1, len(languages)))
    for i, text in enumerate(texts):
        if text and languages and _LETTER.search(text):
            blank[i] = False
            counts = np.zeros(len(logp), dtype=np.int64)
            for h in gram_buckets(text, max_n, len(logp)):
                counts += np.bincount(h, minlength=len(logp))
            found = np.flatnonzero(counts)
            held.append((i, found, counts[found]))
            size += len(found)
            if size >= most:
                _multiply(held, logp, total, most)
                held, size = [], 0
    _multiply(held, logp, total, most)
    if not languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    best = total.argmax(axis=1)
    chars = np.array([max(1, len(t or "")) for t in texts])
    gap = (total - total.max(axis=1, keepdims=True)) * (np.minimum(chars, 64) / chars)[:, None]
    score = 1 / np.exp(gap).sum(axis=1)
    score[blank] = 0
    return [UNKNOWN if b else languages[k] for b, k in zip(blank, best)], score


def _multiply(held: list[tuple[int, np.ndarray, np.ndarray]], logp: np.ndarray, total: np.ndarray, most: int) -> None:
    """Add the product of the texts' sparse counts and the matrix to ``total``, ``most`` cells of counts at a time."""
    if not held:
        return
    rows = np.repeat([i for i, _, _ in held], [len(found) for _, found, _ in held])
    buckets, counts = (np.concatenate([x[k] for x in held]) for k in (1, 2))
    for at in range(0, len(rows), most):
        row = rows[at:at + most]
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        cells = logp[buckets[at:at + most]] * counts[at:at + most, None]
        total[row[starts]] += np.add.reduceat(cells, starts, axis=0)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
            max_n: int = MAX_N) -> DataFrame:
    """The ``keep`` columns, lang_pred, score.  Only the text is looked at."""
    languages = model[0]
    sent = docs.sparkSession.sparkContext.broadcast(model[1])
    slim = docs.select(*keep, F.col(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, score = score_texts(b.column("__text").to_pylist(), languages, sent.value, max_n)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(found, pa.string()), pa.array(score)], [*b.schema.names[:-1], "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    return map_batches(slim, run, f"{kinds}, lang_pred string, score double")
