"""Heuristic answer metrics and derived governance scores as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracelake.functions.text import word_count, words

# Question words that carry no meaning for relevance.
STOP_WORDS = ["what", "is", "the", "of", "who", "did", "in", "a", "an"]

# Weights of the composite score, the quality assumed when none was given, the risk threshold.
COMPLIANCE_WEIGHT = 0.5
FAITHFULNESS_WEIGHT = 0.3
QUALITY_WEIGHT = 0.2
DEFAULT_QUALITY = 0.8
RISK_THRESHOLD = 0.75


def clamp(value: Column, low: float | None = None, high: float | None = None) -> Column:
    if low is not None:
        value = F.greatest(value, F.lit(low))
    if high is not None:
        value = F.least(value, F.lit(high))
    return value


def keyword_overlap(left: Column, right: Column) -> Column:
    return F.size(F.array_intersect(left, right))


def accuracy(output: Column, expected: Column) -> Column:
    """1 if the expected answer occurs in the output, whatever the case."""
    return F.lower(output).contains(F.lower(expected)).cast("double")


def accuracy_reason(output: Column, expected: Column) -> Column:
    return F.when(accuracy(output, expected) == 1.0, "Answer found in output").otherwise("Answer not found in output")


def question_keywords(question: Column) -> Column:
    """Distinct keywords. The stop-word test sees the word with its question mark, which is stripped only afterwards."""
    kept = F.filter(words(F.lower(question)), lambda w: ~w.isin(STOP_WORDS))
    return F.array_distinct(F.transform(kept, lambda w: F.regexp_replace(w, r"^\?+|\?+$", "")))


def relevance(output: Column, question: Column) -> Column:
    """Share of the question's keywords that are words of the output."""
    keywords = question_keywords(question)
    overlap = keyword_overlap(keywords, words(F.lower(output)))
    return F.round(clamp(overlap / F.greatest(F.size(keywords), F.lit(1)), high=1.0), 3)


def relevance_reason(output: Column, question: Column) -> Column:
    keywords = question_keywords(question)
    return F.format_string("Keyword overlap: %d/%d", keyword_overlap(keywords, words(F.lower(output))), F.size(keywords))


def conciseness(output: Column) -> Column:
    """Falls from five words on and ends at zero; fewer than five words give more than one."""
    return F.round(clamp(F.lit(1.0) - (word_count(output) - 5) / 30, low=0.0), 3)


def conciseness_reason(output: Column) -> Column:
    return F.concat(F.lit("Output word count: "), word_count(output).cast("string"))


def equals(output: Column, reference: Column) -> Column:
    return F.coalesce((output == reference).cast("double"), F.lit(0.0))


def score_map(entries: Column) -> Column:
    """Name to value; entries without a name or value are dropped and a later duplicate wins."""
    named = F.filter(entries, lambda e: e["name"].isNotNull() & (e["name"] != "") & e["value"].isNotNull())
    return F.map_from_entries(F.transform(named, lambda e: F.struct(e["name"], e["value"])))


def has_required(scores: Column, names: Sequence[str]) -> Column:
    return F.size(F.array_except(F.array(*[F.lit(n) for n in names]), F.map_keys(scores))) == 0


def composite_risk(scores: Column) -> Column:
    """Weighted composite; null unless compliance and hallucination are both there, quality has a default."""
    compliance = scores["regulatory_compliance"]
    hallucination = scores["hallucination_rate"]
    quality = F.coalesce(scores["response_quality"], F.lit(DEFAULT_QUALITY))
    weighted = COMPLIANCE_WEIGHT * compliance + FAITHFULNESS_WEIGHT * (1.0 - hallucination) + QUALITY_WEIGHT * quality
    return F.round(weighted, 4)


def oversight_flag(composite: Column, threshold: float = RISK_THRESHOLD) -> Column:
    return (composite < threshold).cast("double")


def cost_per_quality(scores: Column) -> Column:
    quality = scores["response_quality"]
    return F.round(F.when(quality != 0, scores["cost_usd"] / quality), 6)
