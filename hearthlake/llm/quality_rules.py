"""Quality rules as a short-circuit cascade (operator 3). DataFrame functions only.

The base counts are column functions of the whole text. The rules form a cascade: a
row leaves at the first rule that rejects it, and later rules aren't computed for it.
Their order comes from a sample, cheapest rejection first; since a row goes if any rule
rejects it, the order changes the cost and never the verdict.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.llm.common import WHITE, checkpointed, given, let, whole_text, words

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
#: Rows of the sample that costs and selectivities come from.
SAMPLE_ROWS = 1000
SAMPLE_SEED = 5


def count_matching(text: Column, pattern: str) -> Column:
    """How many characters match a class of ASCII characters."""
    return (F.octet_length(text) - F.octet_length(F.regexp_replace(text, pattern, ""))).cast("long")


def word_chars(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, WHITE, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return count_matching(text, SYMBOLS + "+")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))


def n_dup_lines(text: Column) -> Column:
    return let(lines_with_words(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeat_words_of(tokens: Column) -> Column:
    """Words that lie in a window of three found twice or more, from the array of words.

    The windows are sorted by a 64-bit hash of their words with their place beside it, so
    equal windows are neighbours: n log n in the words of a text, however often a window
    repeats. Two different windows of a text share a hash once in 10^10 texts of 20,000 words.
    """

    def windows(w: Column) -> Column:
        triples = F.arrays_zip(w, F.slice(w, F.lit(2), F.size(w)), F.slice(w, F.lit(3), F.size(w))).cast("array<struct<a:string,b:string,c:string>>")
        whole = F.slice(triples, F.lit(1), F.size(w) - 2)
        return F.sort_array(F.transform(whole, lambda t, i: F.struct(F.xxhash64(t["a"], t["b"], t["c"]).alias("h"), i.alias("p"))))

    def repeated(s: Column) -> Column:
        n = F.size(s) - 1
        pairs = F.zip_with(F.slice(s, F.lit(1), n), F.slice(s, F.lit(2), n), lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))

    def covered(d: Column) -> Column:
        n = F.size(d) - 1
        steps = F.zip_with(F.slice(d, F.lit(1), n), F.slice(d, F.lit(2), n), lambda a, b: F.least(F.lit(3), b - a))
        return F.when(F.size(d) > 0, F.aggregate(steps, F.lit(3), lambda total, step: total + step)).otherwise(0)

    found = let(windows(tokens), lambda s: F.when(F.size(s) > 1, let(repeated(s), covered)).otherwise(0))
    return F.when(F.size(tokens) > 3, found).otherwise(0).cast("long")


@dataclass(frozen=True)
class Counts:
    """What rules look at: columns that are there, or expressions over the text that are computed where they are used."""

    text: Column
    n_words: Column
    word_chars: Column
    n_symbols: Column
    n_dup_lines: Column
    n_repeat_words: Column


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def counts_of(text: Column, tokens: Column) -> Counts:
    return Counts(text, F.size(tokens).cast("long"), word_chars(text), n_symbols(text), n_dup_lines(text), repeat_words_of(tokens))


@dataclass(frozen=True)
class Rule:
    """A rule rejects a row where ``reject`` of its counts is true; it is never NULL."""

    name: str
    reject: Callable[[Counts], Column]


#: Fixed rules: too few words, or over half of the words in repeated windows.
BASE_RULES = (
    Rule("few_words", lambda c: c.n_words < MIN_WORDS),
    Rule("repeats", lambda c: c.n_repeat_words * 100 > c.n_words * 50),
)
#: Further rules: markup symbols, length of words, repeated lines, capitals, digits.
OWN_RULES = (
    Rule("symbols", lambda c: c.n_symbols * 10 > c.n_words),
    Rule("word_length", lambda c: (c.word_chars < c.n_words * 2) | (c.word_chars > c.n_words * 15)),
    Rule("repeated_lines", lambda c: c.n_dup_lines * 2 > F.size(lines_with_words(c.text))),
    Rule("capitals", lambda c: count_matching(c.text, "[A-Z]+") * 2 > c.word_chars),
    Rule("digits", lambda c: count_matching(c.text, "[0-9]+") * 10 > c.word_chars * 3),
)


def first_rejection(rules: Sequence[Rule], counts: Counts) -> Column:
    """The name of the first rule that rejects the row, NULL if none does; later rules aren't evaluated."""
    found = F.lit(None).cast("string")
    for rule in reversed(rules):
        found = F.when(rule.reject(counts), F.lit(rule.name)).otherwise(found)
    return found


def cascade_order(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejection per cost on a sample of about ``sample_rows`` rows, best first.

    Selectivity is the share that a rule rejects. Cost is the time an aggregate over the
    stored sample takes beyond reading it, the better of two runs. Ties, and an empty
    sample, keep the given order.
    """
    fraction = min(1.0, sample_rows / max(1, docs.count()))
    sample = checkpointed(docs.select(whole_text().alias("_text")).sample(fraction=fraction, seed=SAMPLE_SEED))

    def rejects(rule: Rule) -> Column:
        return let(words(F.col("_text")), lambda w: rule.reject(counts_of(F.col("_text"), w)).cast("int"))

    def seconds(what: Column) -> float:
        best = math.inf
        for _ in range(2):
            start = time.perf_counter()
            sample.agg(F.sum(what)).first()
            best = min(best, time.perf_counter() - start)
        return best

    shares = sample.agg(*[F.avg(rejects(r)).alias(r.name) for r in rules]).first()
    reading = seconds(F.octet_length("_text"))
    costs = {r.name: max(1e-3, seconds(rejects(r)) - reading) for r in rules}
    return sorted(rules, key=lambda r: -(shares[r.name] or 0.0) / costs[r.name])


def judged(docs: DataFrame, rules: Sequence[Rule] = OWN_RULES) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and rejected_by, one row for each row of ``docs`` (doc_id, text).

    NULL text counts as empty: no words, so it fails the base rules. Rows that repeat
    are judged each for itself. ``rejected_by`` names the rule that the cascade stopped
    at; with several rules against a row it depends on the order found on the sample,
    the verdict doesn't. An empty table gives an empty result. No shuffle.
    """
    split = docs.select("doc_id", whole_text().alias("_text")).withColumn("_words", words(F.col("_text")))
    counted = counts_of(F.col("_text"), F.col("_words"))
    rows = split.withColumns({name: getattr(counted, name) for name in BASE})
    counts = Counts(F.col("_text"), *[F.col(name) for name in BASE])
    base = BASE_RULES[0].reject(counts) | BASE_RULES[1].reject(counts)
    verdict = first_rejection(cascade_order(docs, rules), counts)
    return (
        rows.withColumn("base_failed", base)
        .withColumn("rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(verdict))
        .withColumn("kept", F.col("rejected_by").isNull())
        .select("doc_id", *BASE, "base_failed", "kept", "rejected_by")
    )


def passing(docs: DataFrame, rules: Sequence[Rule] = BASE_RULES + OWN_RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns; counts that the cascade doesn't reach aren't computed. No shuffle."""
    ordered = cascade_order(docs, rules)
    kept = let(words(whole_text()), lambda w: first_rejection(ordered, counts_of(whole_text(), w)).isNull())
    return docs.where(kept)


def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(given(spark, sf_dir, "documents")).drop("rejected_by")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id
), counted AS (
  SELECT t.doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM t LEFT JOIN covered c ON t.doc_id = c.doc_id
), based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * n_dup_lines > n_lines
    OR 2 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > word_chars
    OR 10 * (length(t) - length(regexp_replace(t, '[0-9]', '', 'g'))) > 3 * word_chars) AS kept
FROM based
"""
