"""Line-first quality rules: judge lines, remove the failing ones, reject texts that lose too much."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, count_words, let, split_words, whole

# Patterns that Java and RE2 read alike.
SENTENCE_END = r"[.!?…。！？]"
NOISE = r"[#*$%&|<>]|[!?][!?]"
SEPARATOR = r"[|»›•]"
MENU = r"^[^a-zA-Z0-9]*(home|menu|login|log in|sign in|sign up|register|search|next|previous|back to top|contact us|about us|site map|sitemap|share this|read more|skip to content)[^a-zA-Z0-9]*$"
BOILERPLATE = (
    r"(all rights reserved|licensed under|released under the|this work is licensed|copyright|\(c\) [0-9]{4}|©|cookie|"
    r"privacy policy|terms of (use|service)|enable javascript|subscribe to|newsletter|click here|powered by)"
)
# Boilerplate lines are short; a long line that mentions such a phrase is prose.
BOILERPLATE_WORDS = 30
MAX_LOST_PERCENT = 50


def _fails(line: Column) -> Column:
    """Whether a line with words breaks a rule."""
    return let(
        count_words(line),
        lambda n: (
            # punctuation: no sentence ends in it, or marks on more than a fifth of its words
            (~F.regexp_like(line, F.lit(SENTENCE_END)))
            | (F.regexp_count(line, F.lit(NOISE)) * 5 > n)
            # navigation: mostly separators, or nothing but a menu entry
            | ((F.regexp_count(line, F.lit(SEPARATOR)) >= 2) & (F.regexp_count(line, F.lit(SEPARATOR)) * 4 > n))
            | ((n <= 4) & F.regexp_like(F.lower(line), F.lit(MENU)))
            | ((n <= BOILERPLATE_WORDS) & F.regexp_like(F.lower(line), F.lit(BOILERPLATE)))
        ),
    )


def _repeat_words(words: Column) -> Column:
    """How many words lie in a three-word window that occurs twice or more."""

    def covered(starts: Column) -> Column:
        gaps = F.transform(
            starts, lambda p, k: F.coalesce(F.least(F.lit(3), F.get(starts, k + 1) - p), F.lit(3)).cast("bigint")
        )
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, g: a + g)

    def repeated(sorted_windows: Column) -> Column:
        same = lambda e, j: (
            (F.get(sorted_windows, j - 1)["h"] == e["h"]) | (F.get(sorted_windows, j + 1)["h"] == e["h"])
        )
        return F.sort_array(F.transform(F.filter(sorted_windows, lambda e, j: F.coalesce(same(e, j), F.lit(False))), lambda e: e["i"]))

    def count(hashes: Column) -> Column:
        windows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            let(let(windows, repeated), covered),
        ).otherwise(F.lit(0).cast("bigint"))

    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), window)
    return F.when(F.size(words) >= 3, let(hashes, count)).otherwise(F.lit(0).cast("bigint"))


def judge(text: Column, min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    """A struct of the counts, the verdict and the cleaned text."""
    text = whole(text)

    def of_lines(lines: Column) -> Column:
        good = F.filter(lines, lambda line: ~(F.regexp_like(line, F.lit(WORD)) & _fails(line)))
        with_word = F.filter(lines, lambda line: F.regexp_like(line, F.lit(WORD)))
        dup = let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x)))
        return F.struct(dup.cast("bigint").alias("dup"), F.array_join(good, "\n").alias("cleaned"))

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("bigint").alias("n"), _repeat_words(words).alias("repeat"))

    def verdict(w: Column, ln: Column) -> Column:
        base_failed = (w["n"] < min_words) | (w["repeat"] * 100 > max_repeat_percent * w["n"])
        lost = w["n"] - count_words(ln["cleaned"])
        return F.struct(
            w["n"].alias("n_words"),
            (F.char_length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("bigint").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
            ln["dup"].alias("n_dup_lines"),
            w["repeat"].alias("n_repeat_words"),
            base_failed.alias("base_failed"),
            (~base_failed & (lost * 100 <= MAX_LOST_PERCENT * w["n"])).alias("kept"),
            lost.alias("n_lost_words"),
            ln["cleaned"].alias("cleaned"),
        )

    return let(let(split_words(text), of_words), lambda w: let(let(F.split(text, "\n"), of_lines), lambda ln: verdict(w, ln)))


def quality_report(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every row of ``docs``.

    Null and empty texts have no words and fail. Ids are carried as they are, null
    or repeated ones too; other columns are not read. An empty table gives no row.
    """
    judged = docs.select("doc_id", judge(F.col("text")).alias("_q"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words"]
    return judged.select("doc_id", *[F.col(f"_q.{n}") for n in names])


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that pass, with all columns; ``text`` has lost its failing lines."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    # inline, unlike a filter above the projection, judges each text once
    passed = docs.select(*others, F.inline(F.filter(F.array(judge(F.col("text"))), lambda q: q["kept"])))
    return passed.select(*[F.col("cleaned").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]) if not (
        set(docs.columns) & {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words", "cleaned"}
    ) else _keep_clashing(docs)


def _keep_clashing(docs: DataFrame) -> DataFrame:
    """As ``keep_good``, for tables that have columns of the verdict's names."""
    hidden = docs.select(F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all"))
    passed = hidden.select("_all", F.inline(F.filter(F.array(judge(F.col("text"))), lambda q: q["kept"])))
    return passed.select(*[F.col("cleaned").alias("text") if c == "text" else F.col("_all").getField(c).alias(c) for c in docs.columns])


QUALITY_SQL = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT r, regexp_extract_all(t, '{WORD}') AS ws FROM texts
), windows AS (
    SELECT r, i, [ws[i], ws[i + 1], ws[i + 2]] AS g
    FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), twice AS (
    SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) >= 2
), repeats AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), lines AS (
    SELECT r, unnest(string_split(t, chr(10))) AS line FROM texts
), judged AS (
    SELECT r, line, len(regexp_extract_all(line, '{WORD}')) AS n FROM lines WHERE regexp_matches(line, '{WORD}')
), line_counts AS (
    SELECT r, count(*) - count(DISTINCT line) AS dup,
        coalesce(sum(n) FILTER (
            NOT regexp_matches(line, '{SENTENCE_END}')
            OR len(regexp_extract_all(line, '{NOISE}')) * 5 > n
            OR (len(regexp_extract_all(line, '{SEPARATOR}')) >= 2 AND len(regexp_extract_all(line, '{SEPARATOR}')) * 4 > n)
            OR (n <= 4 AND regexp_matches(lower(line), '{MENU}'))
            OR (n <= {BOILERPLATE_WORDS} AND regexp_matches(lower(line), '{BOILERPLATE}'))), 0) AS lost
    FROM judged GROUP BY r
), counts AS (
    SELECT doc_id, len(ws)::BIGINT AS n_words,
        (length(t) - length(regexp_replace(t, '{WORD}', '', 'g')))::BIGINT AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS n_lost_words
    FROM texts JOIN w USING (r) LEFT JOIN line_counts USING (r) LEFT JOIN repeats p USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lost_words * 100 <= {MAX_LOST_PERCENT} * n_words AS kept
FROM counts
"""
