"""Quality rules as a short-circuit cascade: rules are ordered by rejections per cost, both estimated on a sample."""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from voltmart.llm.common import id_text
from voltmart.session import materialize

#: Documents (expected) that costs and selectivities are estimated on; they decide the order of the rules, never a verdict.
SAMPLE_DOCS = 500
#: Times each of them is judged when a rule is timed.
COPIES = 5


@dataclass(frozen=True)
class Rule:
    """``statistic`` is an expression of the text and the base statistics; the rule rejects where ``rejects`` holds."""

    name: str
    statistic: str
    rejects: str


_WORDS = "filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"

#: Words in windows of eight that occur twice or more. Windows are hashed and ordered by (hash, start); the starts of equal
#: neighbours, ordered again, are the repeated windows, of which each adds the words that the one before does not cover.
_REPEATED = """
aggregate(
  array_sort(flatten(transform(
    array(array_sort(transform(sequence(0, size(words) - 8), i -> named_struct(
      'h', xxhash64(words[i], words[i+1], words[i+2], words[i+3], words[i+4], words[i+5], words[i+6], words[i+7]), 'i', i)))),
    s -> transform(filter(transform(s, (x, k) -> named_struct('i', x.i,
        'twice', (k > 0 AND s[greatest(k - 1, 0)].h = x.h) OR (k + 1 < size(s) AND s[least(k + 1, size(s) - 1)].h = x.h))),
      x -> x.twice), x -> x.i)))),
  named_struct('n', 0L, 'end', 0),
  (a, i) -> named_struct('n', a.n + (i + 8 - greatest(i, a.end)), 'end', i + 8),
  a -> a.n)"""

STATISTICS = {
    "n_words": "CAST(size(words) AS BIGINT)",
    "word_chars": "CAST(char_length(regexp_replace(text, '[\\\\x20\\\\x09-\\\\x0D]+', '')) AS BIGINT)",
    "n_symbols": "CAST(char_length(text) - char_length(translate(text, '#*$%&|<>', '')) AS BIGINT)",
    "n_dup_lines": """CAST(aggregate(transform(
        array(filter(split(text, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')),
        l -> size(l) - size(array_distinct(l))), 0, (a, x) -> a + x) AS BIGINT)""",
    "n_repeat_words": f"CASE WHEN size(words) >= 9 THEN {_REPEATED} ELSE 0L END",
}

BASE = ("n_words < 20", "100 * n_repeat_words > 30 * n_words")

#: Rules beyond the base, over the base statistics and a few cheap ones of their own.
RULES = (
    Rule("short_or_long_words", "CAST(word_chars AS DOUBLE) / n_words", "value < 2 OR value > 20"),
    Rule("symbols", "CAST(n_symbols AS DOUBLE) / n_words", "value > 0.3"),
    Rule("duplicate_lines", "CAST(n_dup_lines AS DOUBLE) / greatest(1, size(split(text, '\\n')))", "value > 0.3"),
    Rule("shouting", "CAST(char_length(regexp_replace(text, '[^A-Z]', '')) AS DOUBLE) / greatest(1, word_chars)", "value > 0.5"),
    Rule("few_letters", f"CAST(size(filter({_WORDS}, w -> w rlike '[A-Za-z\\\\x{{80}}-\\\\x{{10FFFF}}]')) AS DOUBLE) / n_words", "value < 0.6"),
)


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and the base statistics of each row; a null text has no words.

    The words are the variable of a lambda: a filter that is pushed down copies whole expressions, and must not split the
    text again for each word.
    """
    rows = id_text(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    fields = ", ".join(f"'{k}', {e}" for k, e in STATISTICS.items())
    found = F.expr(f"transform(array({_WORDS}), words -> named_struct({fields}))[0]")
    rows = rows.withColumn("found", found).select("doc_id", "text", "found.*")
    return rows.withColumn("base_failed", F.expr(" OR ".join(f"({b})" for b in BASE)))


def _rejection(rule: Rule) -> Column:
    return F.coalesce(F.expr(f"transform(array({rule.statistic}), value -> {rule.rejects})[0]"), F.lit(False))


def _seconds(rows: DataFrame, value: Column) -> float:
    """Seconds of a job that adds up ``value``, the lesser of two runs."""
    taken = []
    for _ in range(2):
        begin = time.perf_counter()
        rows.agg(F.sum(value)).collect()
        taken.append(time.perf_counter() - begin)
    return min(taken)


def cascade(docs: DataFrame, rules=RULES, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text"):
    """``rules`` in the order in which they are tried: by rejected documents per second on a sample, most first.

    A rule's cost is the time of a job over the sample, each row ``COPIES`` times, less that of a job that only reads the
    texts; so start-up does not count. Costs below a 64th of the greatest are taken for that. Rates are compared by their
    power of two, and rules of one power stay in the order given, so the order is the same for all but borderline rates.
    It only decides how much work a rejected document takes. Rules that reject nothing come last, cheap ones first.
    """
    rows = id_text(docs, id_col, text_col)
    size = max(1, rows.count())
    sample = materialize(
        with_statistics(rows.sample(fraction=min(1.0, sample_docs / size), seed=7)).filter("NOT base_failed")
    )
    counted = sample.agg(
        F.count("*").alias("rows"), *[F.sum(_rejection(rule).cast("int")).alias(rule.name) for rule in rules]
    ).first()
    if not counted["rows"]:
        return list(rules)
    copies = sample.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
    reading = _seconds(copies, F.length("text"))
    costs = [_seconds(copies, _rejection(rule).cast("int")) - reading for rule in rules]
    return ordered(rules, [counted[rule.name] for rule in rules], costs)


def ordered(rules, rejected: list[int], costs: list[float]) -> list[Rule]:
    """``rules`` by the powers of two of rejections per cost, then as given."""
    least = max(1e-9, max(costs, default=0.0) / 64)

    def rank(k: int) -> tuple[bool, int]:
        cost = max(costs[k], least) / least
        return not rejected[k], -round(math.log2(max(1, rejected[k]) / cost))

    return [rules[k] for k in sorted(range(len(rules)), key=rank)]


def assess(docs: DataFrame, rules=RULES, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the base statistics, base_failed, kept and rejected_by (null if kept).

    The base rules and then the cascade form one CASE, so a rule is evaluated only for documents that all rules before it
    let pass. ``kept`` does not depend on the order; ``rejected_by`` names the first rule in the order given. Empty and
    null texts have no words and fail the base; repeated rows are judged each; an empty table gives no row. Texts are
    judged whole, whatever their length. Repeated windows are found by 64-bit hashes of their words (``n_repeat_words``).
    """
    tried = cascade(docs, rules, sample_docs, id_col, text_col)
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for rule in tried:
        verdict = verdict.when(_rejection(rule), F.lit(rule.name))
    rows = with_statistics(docs, id_col, text_col).withColumn("rejected_by", verdict)
    return rows.select(
        "doc_id", *STATISTICS, "base_failed", F.col("rejected_by").isNull().alias("kept"), "rejected_by"
    )
