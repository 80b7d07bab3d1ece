"""Quality rules with host-level verdicts, in DataFrame functions only.

Each document is measured by itself and checked against row rules.  The failures are
counted for each host; a host's failure rate is shrunk towards the corpus's by an empirical beta prior,
fitted to all hosts by the method of moments, so that a host with a few documents is
not judged by chance.  The verdicts join back to the documents.  A host's shrunk rate is the prior of a
document that breaks a rule: its odds, rate / (1 - rate), times the document's evidence, how many times over its worst
rule's limit it is, are the odds that it is bad.  Beyond ``BAD_ODDS`` it goes, so gross junk goes from any host and a
slight failure only from a bad one.  A document that breaks no rule always stays; the hard rule (``base_failed``) always removes.

Defined cases: a null text has no words (and fails the hard rule); null hosts form one host; null or
repeated ids are kept as rows of their own; extra columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asklens.llm.common import join_groups, let, numbered, written

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BAD_ODDS = 1.0

#: The rules of a document, as SQL over its measures; any of them counts as a failure.
RULES = {
    "too_few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
}
#: How many times its limit a document reaches, rule by rule (the first one is the hard rule's).
EXCESS = {
    "repeated_windows": "100.0D * n_repeat_words / nullif(30.0D * n_words, 0)",
    "many_symbols": "10.0D * n_symbols / nullif(n_words, 0)",
    "repeated_lines": "10.0D * n_dup_lines / nullif(3.0D * n_lines, 0)",
    "short_words": "2.0D * n_words / nullif(word_chars, 0)",
    "long_words": "word_chars / nullif(15.0D * n_words, 0)",
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def _windows(words: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(words) - 2), lambda i: F.concat_ws(
        " ", F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)))


def _covered(windows: Column) -> Column:
    """Words in those windows that stand twice or more: each adds the words up to the next one's start, three at most."""
    # sorted by (window, place), equal windows stand side by side
    placed = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    starts = let(placed, lambda p: F.array_sort(F.transform(F.filter(
        F.transform(p, lambda x, k: F.struct(x["i"].alias("i"), (
            F.coalesce(F.get(p, k - 1)["w"] == x["w"], F.lit(False))
            | F.coalesce(F.get(p, k + 1)["w"] == x["w"], F.lit(False))).alias("twice"))),
        lambda x: x["twice"]), lambda x: x["i"])))
    return let(starts, lambda s: F.aggregate(
        F.transform(s, lambda x, k: F.least(F.coalesce(F.get(s, k + 1) - x, F.lit(3)), F.lit(3))),
        F.lit(0), lambda total, x: total + x))


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that the text holds twice or more."""
    some = lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), _covered(w)).otherwise(F.lit(0))
    return let(words, lambda v: F.when(F.size(v) >= 4, let(_windows(v), some)).otherwise(F.lit(0)))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with MEASURES, ``base_failed``, ``failed`` and ``evidence``; every column it had stays."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({"__words": F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), "__lines": lines})
    out = out.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": _repeat_words(F.col("__words")).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
    }).drop("__words", "__lines")
    base = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    return out.withColumns({"base_failed": F.expr(base),
                            "failed": F.expr(" OR ".join(f"({r})" for r in RULES.values())),
                            "evidence": F.coalesce(F.expr(f"greatest({', '.join(EXCESS.values())})"), F.lit(0.0))})


def host_verdicts(docs: DataFrame) -> DataFrame:
    """One row per host of ``docs(host, failed)``: n_docs, n_failed, host_rate (shrunk).

    The prior is Beta(m * s, (1 - m) * s): m is the mean of the hosts' rates weighted by their documents, v its
    weighted variance, s = m * (1 - m) / v - 1, held between 1 and 1000 documents."""
    hosts = docs.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"),
                                     F.sum(F.col("failed").cast("long")).alias("n_failed"))
    hosts = written(hosts, "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    sums = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"),
                     F.sum(rate * F.col("n_failed")).alias("rf"))
    prior = sums.select((F.col("f") / F.col("n")).alias("m"),
                        (F.col("rf") / F.col("n") - (F.col("f") / F.col("n")) * (F.col("f") / F.col("n"))).alias("v"))
    strength = F.when(F.col("v") * 1001 <= F.col("m") * (1 - F.col("m")), F.lit(1000.0)).when(
        F.col("v") * 2 >= F.col("m") * (1 - F.col("m")), F.lit(1.0)).otherwise(
        F.col("m") * (1 - F.col("m")) / F.col("v") - 1)
    prior = prior.select(F.struct("m", strength.alias("s")).alias("p")).scalar()
    judged = hosts.withColumn("__p", prior)
    shrunk = (F.col("n_failed") + F.col("__p.m") * F.col("__p.s")) / (F.col("n_docs") + F.col("__p.s"))
    return judged.select("host", "n_docs", "n_failed", shrunk.alias("host_rate"))


def quality_rules(docs: DataFrame, text_col: str = "text", host_col: str = "source", keep: tuple[str, ...] = ("doc_id",),
                  bad_odds: float = BAD_ODDS) -> DataFrame:
    """One row per row of ``docs``: the ``keep`` columns, host, MEASURES, base_failed, failed, evidence, host_rate, bad, kept."""
    slim = docs.select(*keep, F.col(host_col).alias("host"), F.col(text_col).alias("__text"))
    rows = written(measured(slim, "__text").drop("__text"), "measured")
    hosts = written(host_verdicts(rows), "verdicts")
    out = join_groups(rows, hosts, ["host"], "n_docs")
    # odds * evidence > bound, without dividing by a rate of one
    bad = F.col("failed") & (F.col("host_rate") * F.col("evidence") > (1 - F.col("host_rate")) * bad_odds)
    return out.select(*keep, "host", *MEASURES, "base_failed", "failed", "evidence", "host_rate", bad.alias("bad"),
                      (~F.col("base_failed") & ~bad).alias("kept"))


def drop_rejected(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``docs`` without the rejected rows, all columns as they were."""
    rows, row = numbered(docs)
    kept = quality_rules(rows, text_col, host_col, (row,)).where("kept").select(row)
    return rows.join(kept, row, "left_semi").drop(row)
