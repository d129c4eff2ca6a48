"""Quality rules with cross-document line frequency, in DataFrame functions only.

Lines are normalised (lower case, digits as 0, white space as one blank) and hashed. Per host the documents that hold a
line are counted; lines in more documents than the host's limit are removed, and a document that loses too many of its
words is rejected. A number of documents is limit enough in any host, however large; in small hosts a share of the
documents is one too, above a least count. Lines meet the frequent (host, hash) rows one by one, so no row or task holds
a host; the places of what goes, and how many words stand there, are gathered per text. Counts are combined before they
are shuffled. Rules look at a text before it meets those places, so texts are shuffled only where clean_text is asked for
and the table of the places is too large for Spark to broadcast.

The base rules look at a document alone. Repeated five-word windows are found by sorting (hash, position) in one long:
64 less the bits of the position stay for the hash, more than 49 for a text of 20,000 words.

A null or empty text has no words and is rejected. A null host is a host of its own. Every row counts as a document, also
repeated ones. An input column with the name of a result column is replaced; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapline.llm.common import SPACES, staged, table, with_columns


@dataclass(frozen=True)
class Limits:
    """A line is removed when more than `many` of the host's documents hold it, or more than `documents` and more than
    `share` of them; a document goes when less than `left` of its words, or fewer than `words`, are left."""

    share: float = 0.05
    documents: int = 10
    many: int = 50
    left: float = 0.5
    words: int = 10


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), SPACES, " "))


def with_base(docs: DataFrame, text: Column) -> DataFrame:
    """Add word_chars, n_symbols, n_dup_lines, n_repeat_words and n_words; `text` must not be null."""
    with_words = docs.withColumns({"_w": words_of(text), "_l": F.filter(F.split(text, "\n"), lambda x: x.rlike(
        r"[^\x20\x09-\x0D]"))})
    counted = with_words.select(
        "*", F.size("_w").cast("long").alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.expr("cast(ceil(log2(size(_w) + 1)) as int)").alias("_k"),
    )
    # Windows by hash and place. Up to 4,095 words both fit in one number that is quick to sort, with 52 bits of hash or
    # more; longer texts sort all 64 bits beside the place.
    places = counted.withColumn("_s", F.expr("""
        if(size(_w) < 5 or _k > 12, cast(array() as array<bigint>), sort_array(transform(
            sequence(1, size(_w) - 4), i -> shiftleft(xxhash64(slice(_w, i, 5)), _k) | cast(i as bigint))))""")).withColumn(
        "_t", F.expr("""
        if(_k <= 12, cast(array() as array<struct<h: bigint, p: bigint>>), sort_array(transform(
            sequence(1, size(_w) - 4), i -> struct(xxhash64(slice(_w, i, 5)) as h, cast(i as bigint) as p))))""")).withColumn(
        "_p", F.expr("""
        sort_array(if(_k <= 12, transform(filter(_s, (x, i) -> (i > 0 and shiftright(x, _k) = shiftright(_s[i - 1], _k))
                or (i < size(_s) - 1 and shiftright(x, _k) = shiftright(_s[i + 1], _k))), x -> x & (shiftleft(1L, _k) - 1)),
            transform(filter(_t, (x, i) -> (i > 0 and x.h = _t[i - 1].h) or (i < size(_t) - 1 and x.h = _t[i + 1].h)),
                x -> x.p)))"""))
    return places.withColumn("n_repeat_words", F.expr("""
        aggregate(transform(_p, (p, i) -> if(i = 0, 5L, least(5L, p - _p[i - 1]))), 0L, (a, x) -> a + x)""")).drop(
        "_w", "_l", "_k", "_s", "_t", "_p")


def frequent_lines(docs: DataFrame, limits: Limits, host: Column, text: Column) -> DataFrame:
    """(_host, _h): hashes of the lines above each host's limit."""
    lines = docs.select(host.alias("_host"), F.array_distinct(F.filter(
        F.transform(F.split(text, "\n"), normalised), lambda x: x != "")).alias("_lines"))
    hosts = lines.groupBy("_host").agg(F.count("*").alias("_docs"))
    counts = lines.select("_host", F.explode("_lines").alias("_line")).select(
        "_host", F.xxhash64("_line").alias("_h")).groupBy("_host", "_h").agg(F.count("*").alias("_n"))
    some = counts.where(F.col("_n") > min(limits.documents, limits.many)).join(hosts, "_host")
    return staged(some.where((F.col("_n") > limits.many) | ((F.col("_n") > limits.documents) & (
        F.col("_n") > limits.share * F.col("_docs")))).select("_host", "_h"), "frequent-lines")


def lines_to_remove(docs: DataFrame, limits: Limits, host: Column, text: Column) -> DataFrame:
    """(_key, _gone, _lost): places of the lines that go, and their words, by host and text; texts that lose none are left out."""
    lines = docs.select(F.xxhash64(host, text).alias("_key"), host.alias("_host"), F.posexplode(
        F.transform(F.split(text, "\n"), normalised)).alias("_no", "_line")).where("_line != ''")
    met = lines.select("_key", "_host", "_no", F.size(F.split("_line", " ")).alias("_words"), F.xxhash64("_line").alias(
        "_h")).join(frequent_lines(docs, limits, host, text), ["_host", "_h"], "left_semi")
    places = met.groupBy("_key").agg(F.collect_set(F.struct("_no", "_words")).alias("_places"))
    return staged(places.select("_key", F.col("_places._no").alias("_gone"), F.aggregate(
        "_places._words", F.lit(0).cast("long"), lambda a, x: a + x).alias("_lost")), "frequent-places")


def apply_rules(docs: DataFrame, limits: Limits = Limits(), text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Add the base columns, base_failed, n_removed (words in removed lines), clean_text and kept to every row."""
    text, host = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.concat(F.lit("h"), F.col(host_col)), F.lit(""))
    inner = docs.select(*(docs[f"`{c}`"].alias(f"_c{i}") for i, c in enumerate(docs.columns)), text.alias("_text"),
                        F.xxhash64(host, text).alias("_key"))
    based = with_base(inner, F.col("_text")).join(lines_to_remove(docs, limits, host, text), "_key", "left")
    clean = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(
        F.filter(F.split("_text", "\n"), lambda line, no: ~F.array_contains("_gone", no)), "\n"))
    left = F.col("n_words") - F.coalesce("_lost", F.lit(0))
    judged = based.withColumn("_left_words", left).withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    kept = ~F.col("base_failed") & (F.col("_left_words") >= limits.words) & (
        F.col("_left_words") >= limits.left * F.col("n_words"))
    results = {c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")}
    results |= {"n_removed": F.col("n_words") - F.col("_left_words"), "clean_text": clean, "kept": kept}
    taken = {name.lower() for name in results}
    return judged.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in taken),
                         *(column.alias(name) for name, column in results.items()))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled = apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return ruled.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept", "n_removed")


# The same rows for DuckDB, lines and windows compared as texts instead of by hash.
SQL = r"""
WITH base AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t, coalesce('h' || source, '') AS host,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents),
words AS (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM base),
spelled AS (
    SELECT row, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS g,
           lead(i, 4) OVER o AS last
    FROM words WINDOW o AS (PARTITION BY row ORDER BY i)),
windows AS (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS times FROM spelled WHERE last IS NOT NULL),
repeated AS (
    SELECT row, sum(fresh) AS n FROM (
        SELECT row, least(5, coalesce(i - lag(i) OVER (PARTITION BY row ORDER BY i), 5)) AS fresh FROM windows WHERE times > 1)
    GROUP BY row),
lines AS (
    SELECT row, host, len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
           trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
    FROM (SELECT row, host, unnest(l) AS line FROM base)),
hosts AS (SELECT host, count(*) AS docs FROM base GROUP BY host),
frequent AS (
    SELECT host, norm FROM lines JOIN hosts USING (host) GROUP BY host, norm, docs
    HAVING count(DISTINCT row) > 50 OR count(DISTINCT row) > 10 AND count(DISTINCT row) > 0.05::DOUBLE * docs),
removed AS (SELECT row, sum(words) AS n FROM lines SEMI JOIN frequent USING (host, norm) GROUP BY row),
counted AS (
    SELECT doc_id, len(w) AS n_words, length(coalesce(array_to_string(w, ''), '')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
           coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, coalesce(removed.n, 0)::BIGINT AS n_removed
    FROM base LEFT JOIN repeated USING (row) LEFT JOIN removed USING (row))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - n_removed >= 10
           AND n_words - n_removed >= 0.5 * n_words AS kept
FROM counted
"""
