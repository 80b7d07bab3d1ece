"""Mixing sources to target weights, to the exact word.

Every row gets a hash-random key; rows are range-sorted by (source, key) over all tasks, and
distributed prefix sums give the words of its source that lie before each row.  A source whose target is
``e`` times its size plus a rest is taken ``e`` times as a whole (epochs), and once more as far as the
rest reaches; the row at the cut is taken in part, so each source gives its target, rounded to whole words.

Targets: sources in code-point order (null last) get the weights in turn; the words of all rows are shared
by weight; no source gives more than ``max_epochs`` times its size, and the excess goes to the others by weight.
That is water at one level L: target = min(max_epochs * size, L * weight), with L the largest of
(total - capped sizes) / (weights left) over the sources in the order in which they fill up.

Defined cases: a null or empty text has size 0 and is never taken; a null source is a source of its
own; rows that agree in id, source and text are interchangeable (the hash key ties, any order gives the
same rows); extra columns are not looked at; an empty table, or one without words, gives targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asklens.llm.common import fresh_name, join_groups, numbered, quoted, running_sums, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix"


def n_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources(source, source_size, docs)`` with weight and target (double)."""
    order = [F.col("source").isNull(), F.col("source")]
    placed = running_sums(sources.withColumn("one", F.lit(1).cast("long")), order, ["one"], "sources")
    turn = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                        (F.col("before_one") % len(weights)).cast("int") + 1)
    weighed = placed.select("source", "source_size", "docs", turn.alias("weight"),
                            (F.col("source_size") * max_epochs).alias("cap"))
    # the order in which sources fill up: by cap / weight
    filling = written(running_sums(weighed, [F.col("cap") / F.col("weight"), *order], ["cap", "weight"], "filling"),
                      "filling-order")
    sums = filling.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).select(
        F.struct("words", "weights").alias("s")).scalar()
    levels = filling.withColumn("__s", sums).select(
        ((F.col("__s.words") - F.col("before_cap")) / (F.col("__s.weights") - F.col("before_weight"))).alias("level"))
    level = levels.agg(F.max("level").alias("level")).select("level").scalar()
    target = F.least(F.col("cap").cast("double"), F.col("level_") * F.col("weight"))
    return filling.withColumn("level_", level).select("source", "source_size", "docs", "weight", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        row_col: str | None = None, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: row_no, doc_id, source, size, source_size, target, taken (words, repeats counted)."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    slim = written(docs.select(
        row.alias("row_no"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"))).alias("key"),
        F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("content")), "sizes")
    sources = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    targets = written(source_targets(written(sources, "source-sizes"), weights, max_epochs), "targets")
    placed = running_sums(slim, [F.col("key"), F.col("doc_id"), F.col("content")], ["size"], "mix", ["source"])
    whole = join_groups(placed, targets, ["source"], "docs")
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - F.col("epochs") * F.col("source_size")
    last = F.greatest(F.least(rest - F.col("before_size"), F.col("size")), F.lit(0))
    return (whole.withColumn("epochs", epochs.cast("long"))
            .withColumn("taken", (F.col("epochs") * F.col("size") + last).cast("long"))
            .select("row_no", "doc_id", "source", "size", "source_size", "target", "taken"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to its ``n``-th word, white space as it was."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)),
                                F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a document is taken whole, and the
    first words of those at a cut."""
    rows, row = numbered(docs)
    taken = mix(rows, id_col, text_col, source_col, row, weights, max_epochs, seed).where("taken > 0")
    size, took = fresh_name(rows, "mix_size"), fresh_name(rows, "mix_taken")
    joined = rows.join(taken.select(F.col("row_no").alias(row), F.col("size").alias(size), F.col("taken").alias(took)), row)
    copy = fresh_name(joined, "mix_copy")
    # copies 0 .. are whole, the last one may be cut
    copies = joined.withColumn(copy, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({took} - 1) div {size}"))))
    left = F.col(took) - F.col(copy) * F.col(size)
    text = F.when(left < F.col(size), first_words(F.col(text_col), left)).otherwise(F.col(text_col))
    return copies.select(*[text.alias(c) if c == text_col else F.col(quoted(c)) for c in docs.columns])
