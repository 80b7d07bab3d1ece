"""The registered queries of the training-data operators, and their DuckDB SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asklens.llm import (chat, conversation_sql, exact_dedup, html_text, language_id, licenses, mixing, packing, pii, prefix_trie,
                         quality, simhash, token_output, turn_repair)
from asklens.llm.common import documents, written
from asklens.session import scratch_path


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(licenses.scan_licenses(documents(spark, sf_dir, "doc_id", "text")))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_output.write_tokens(documents(spark, sf_dir, "doc_id", "text"), path, tokenizer_file("word_bpe_49k.json"))
    return token_output.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(pii.find_personal_data(documents(spark, sf_dir, "doc_id", "text")))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    model = language_id.train(docs.where("NOT held_out"))
    return language_id.predict(docs, model, keep=("doc_id", "held_out"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir, "doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir, "doc_id", "text", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir, "doc_id", "text"))


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return chat.render(chat.repair_roles(turns)).select(
        "conv_id", "turn", "pos", "kind", "new_role", F.array_join("inserted", ",").alias("inserted"),
        F.array_join("closing", ",").alias("closing"), "piece")


def rebuilt(placed: DataFrame, ids: DataFrame) -> DataFrame:
    """The conversations that the contract of op11 asks for: the first h turns of conversation c - c % 5, then c's own
    after its first h, h by a checksum of c.  A turn is copied four times at most, and only among the first eight."""
    def shared(conv):
        return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(9))

    own = placed.where(F.col("place") >= shared(F.col("conv_id")))
    step = F.when(F.col("conv_id") < 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    around = F.when(F.col("conv_id") == 0, F.sequence(F.lit(-4).cast("bigint"), F.lit(4).cast("bigint"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.col("conv_id") + step * i))
    given = placed.where("conv_id % 5 = 0 AND place < 8").select(F.explode(around).alias("conv_id"), "place", "content", "n_bytes")
    given = given.where(F.col("place") < shared(F.col("conv_id"))).join(ids, "conv_id", "left_semi")
    return own.select("conv_id", "place", "content", "n_bytes").unionByName(given)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    placed = prefix_trie.placed_turns(prefix_trie.turn_keys(turns))
    ids = written(placed.select("conv_id").distinct(), "conversation-ids")
    return prefix_trie.prefix_trie(rebuilt(placed, ids), ids)


def damaged(turns: DataFrame) -> DataFrame:
    """The faults that the contract of op12 plants, by a checksum of conversation and turn; nulls become one space."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    hit = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), F.pmod(F.crc32(name.cast("binary")), F.lit(20)).alias("hit"))
    text = F.when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return hit.where("hit <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = turn_repair.conversation_report(damaged(turns)).withColumnRenamed("conv_id", "__conv")
    ids = turns.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(found, ids["conv_id"].eqNullSafe(found["__conv"]), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return html_text.extract_main_text(pages).select("page_id", "url", "text", "n_chars")


REGISTRY = {f.__name__: f for f in (
    op1_license_scan, op2_token_output, op3_exact_dedup, op4_personal_data, op5_language_id, op6_simhash_near_dedup,
    op7_source_mixing, op8_quality_rules, op9_window_packing, op10_chat_format, op11_conversation_trie,
    op12_conversation_repair,
    op13_html_extraction)}

# DuckDB SQL over the same tables.  The other operators have no SQL form: a tokenizer's ids (2, 9), rules whose regexes
# look around (1), expectation maximisation (4), hashed n-grams (5), XXH64 (6), dynamic programming (10), parsing of
# HTML (13).
_EXACT_DEDUP = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""

_MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat_ws(':', 'mix', doc_id::VARCHAR)) AS k, md5(coalesce(text, '')) AS content FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 3 * source_size AS cap,
             1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS weight FROM s),
f AS (SELECT *, coalesce(sum(cap) OVER b, 0)::BIGINT AS before_cap, coalesce(sum(weight) OVER b, 0)::BIGINT AS before_weight,
             sum(source_size) OVER ()::BIGINT AS words, sum(weight) OVER ()::BIGINT AS weights
      FROM w WINDOW b AS (ORDER BY cap::DOUBLE / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size,
             least(cap::DOUBLE, max((words - before_cap)::DOUBLE / (weights - before_weight)) OVER () * weight) AS target FROM f),
b AS (SELECT *, round(target)::BIGINT AS budget, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, content
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_size FROM d)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(least(budget - epochs * source_size - before_size, size), 0))::BIGINT AS taken
FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source
"""

_QUALITY = r"""
WITH t AS (SELECT row_number() OVER () AS row_no, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT row_no, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT row_no, unnest(range(1, len(words) - 1)) AS i,
             unnest(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS gram FROM w),
r AS (SELECT row_no, i FROM g QUALIFY count(*) OVER (PARTITION BY row_no, gram) > 1),
c AS (SELECT row_no, sum(n)::BIGINT AS n FROM (
        SELECT row_no, least(coalesce(lead(i) OVER (PARTITION BY row_no ORDER BY i) - i, 3), 3) AS n FROM r) GROUP BY row_no),
m AS (SELECT doc_id, source, len(words)::BIGINT AS n_words, len(lines)::BIGINT AS n_lines,
             length(array_to_string(words, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
      FROM w LEFT JOIN c USING (row_no)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             n_words < 50 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
             OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS failed FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (failed) AS f FROM j GROUP BY source),
a AS (SELECT sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) ** 2 AS v FROM h),
p AS (SELECT m, CASE WHEN v * 1001 <= m * (1 - m) THEN 1000.0 WHEN v * 2 >= m * (1 - m) THEN 1.0 ELSE m * (1 - m) / v - 1 END AS s FROM a),
x AS (SELECT source, (f + m * s) / (n + s) AS rate FROM h, p),
e AS (SELECT *, coalesce(greatest(100.0::DOUBLE * n_repeat_words / nullif(30.0::DOUBLE * n_words, 0),
             10.0::DOUBLE * n_symbols / nullif(n_words, 0), 10.0::DOUBLE * n_dup_lines / nullif(3.0::DOUBLE * n_lines, 0),
             2.0::DOUBLE * n_words / nullif(word_chars, 0), word_chars::DOUBLE / nullif(15.0::DOUBLE * n_words, 0)), 0.0) AS evidence FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (failed AND rate * evidence > 1 - rate) AS kept
FROM e JOIN x ON e.source IS NOT DISTINCT FROM x.source
"""

ORACLE: dict[str, str] = {
    "op3_exact_dedup": _EXACT_DEDUP,
    "op7_source_mixing": _MIXING,
    "op8_quality_rules": _QUALITY,
    "op11_conversation_trie": conversation_sql.TRIE,
    "op12_conversation_repair": conversation_sql.REPAIR,
}
