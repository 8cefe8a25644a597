"""Rule bitmask ledger: every rule is evaluated once, policies and ablations work on the bits.

``ledger`` measures each whole text in one pass and sets one bit per failed rule. ``apply_policy`` keeps
rows by a mask of a named, versioned policy, without looking at a text again; ``ablations`` aggregates the
distinct bit patterns and tells, for each rule of a policy, how many documents it fails, fails alone
and how many would be kept without it.

Repeated windows of 8 words are found by hash first; where two hashes agree, the windows themselves are
compared, so the figures are exact. Null, empty and word-free texts measure 0 and fail ``few_words``.
Rows are independent: ties and repeated rows give equal results, extra columns are ignored, an empty
table gives no rows. Texts are read whole, whatever their length; nothing is shuffled but bit counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tierlake.llm import text as T

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """A failed rule sets ``1 << bit``; the predicate is SQL over the measurements."""

    bit: int
    name: str
    fails: str


# Bits are permanent: a new rule takes a new bit, so stored ledgers stay readable.
RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "n_dup_lines > 2 and 100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule(5, "shouting", "100 * n_upper > 50 * word_chars"),
)
# Versioned policies: names of rules. A published version never changes.
POLICIES = {
    ("base", 1): ("few_words", "repeated_windows"),
    ("web", 1): ("few_words", "repeated_windows", "symbols", "repeated_lines"),
    ("web", 2): tuple(rule.name for rule in RULES),
}


def mask(policy: str, version: int) -> int:
    return sum(1 << rule.bit for rule in RULES if rule.name in POLICIES[policy, version])


def _repeat_words(words: Column) -> Column:
    """Words inside of 8-word windows that the text has twice or more."""
    places = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    word_hashes = F.transform(words, lambda w: F.xxhash64(w))
    hashed = T.let(
        word_hashes, lambda h: F.transform(places, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(-1, WINDOW - 1)]))
    )
    exact = F.array_sort(F.transform(places, lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("w"), i.alias("p"))))

    def covered(windows: Column) -> Column:
        def same(i: Column, step: int) -> Column:
            return F.coalesce(F.get(windows, i + step)["w"] == F.get(windows, i)["w"], F.lit(False))

        twice = F.filter(windows, lambda x, i: (F.when(i > 0, same(i, -1)).otherwise(False)) | same(i, 1))
        places = F.array_sort(F.transform(twice, lambda x: x["p"]))
        return T.let(places, lambda p: F.aggregate(F.transform(p, lambda x, i: _reach(p, x, i)), F.lit(0), lambda a, x: a + x))

    def _reach(p: Column, x: Column, i: Column) -> Column:
        return F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))

    found = T.let(
        hashed, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(T.let(exact, covered))
    )
    return F.when(F.size(words) > WINDOW, found).otherwise(0)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, measurements and ``fail_bits`` of every document."""
    text = F.col("_text")
    words = F.regexp_extract_all(text, F.lit(f"({T.WORD})"), F.lit(1))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(T.WORD))
    measured = docs.select("doc_id", T.text_or_empty().alias("_text")).select(
        "doc_id",
        T.let(words, lambda w: F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("c"), _repeat_words(w).alias("r"))).alias("_words"),
        T.let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("_lines"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("bigint").alias("n_upper"),
    )
    measured = measured.select(
        "doc_id",
        F.col("_words.n").cast("bigint").alias("n_words"),
        F.col("_words.c").cast("bigint").alias("word_chars"),
        "n_symbols",
        (F.col("_lines.n") - F.col("_lines.d")).cast("bigint").alias("n_dup_lines"),
        F.col("_words.r").cast("bigint").alias("n_repeat_words"),
        F.col("_lines.n").cast("bigint").alias("n_lines"),
        "n_upper",
    )
    bits = sum(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(0) for rule in RULES)
    return measured.withColumn("fail_bits", bits.cast("bigint"))


def failed(policy: str, version: int) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy, version))) != 0


def apply_policy(marked: DataFrame, policy: str, version: int) -> DataFrame:
    """The rows of a ledger that no rule of the policy fails."""
    return marked.filter(~failed(policy, version))


def ablations(marked: DataFrame, policy: str, version: int) -> DataFrame:
    """Per rule of a policy: documents it fails, fails alone, and documents kept without it."""
    patterns = marked.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(policy, version))).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).alias("bit")) for r in RULES if r.name in POLICIES[policy, version]])
    one = patterns.select("bits", "n", F.inline(rules))

    def total(when: Column) -> Column:
        return F.sum(F.when(when, F.col("n")).otherwise(0))

    own = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return one.groupBy("rule").agg(
        total(own).alias("n_failed"),
        total(F.col("bits") == F.col("bit")).alias("n_failed_alone"),
        total((F.col("bits") == 0) | (F.col("bits") == F.col("bit"))).alias("n_kept_without"),
    )


def rule_report(docs: DataFrame) -> DataFrame:
    """The ledger with the outcome of the base policy and of the latest one."""
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed("base", 1).alias("base_failed"), (~failed("web", 2)).alias("kept"), "n_lines", "n_upper", "fail_bits",
    )


REPORT_SQL = r"""
with split as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
      [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as lines
  from documents
), windows as (
  select r, unnest(generate_series(1, len(words) - 7)) as p, words from split where len(words) > 8
), twice as (
  select r, p from (select r, p, count(*) over (partition by r, words[p:p + 7]) as n from windows) where n > 1
), reach as (
  select r, least(8, coalesce(lead(p) over (partition by r order by p) - p, 8)) as n from twice
), repeats as (
  select r, sum(n)::bigint as n from reach group by r
), measured as (
  select doc_id, len(words)::bigint as n_words, coalesce(list_sum([length(x) for x in words]), 0)::bigint as word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
      (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(repeats.n, 0)::bigint as n_repeat_words,
      len(lines)::bigint as n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g'))::bigint as n_upper
  from split left join repeats using (r)
), marked as (
  select *, (case when n_words < 20 then 1 else 0 end + case when 100 * n_repeat_words > 30 * n_words then 2 else 0 end
      + case when 10 * n_symbols > n_words then 4 else 0 end + case when n_dup_lines > 2 and 100 * n_dup_lines > 30 * n_lines then 8 else 0 end
      + case when word_chars < 2 * n_words or word_chars > 20 * n_words then 16 else 0 end
      + case when 100 * n_upper > 50 * word_chars then 32 else 0 end)::bigint as fail_bits
  from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 as base_failed,
    fail_bits = 0 as kept, n_lines, n_upper, fail_bits
from marked
"""
