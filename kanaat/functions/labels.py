"""Expressions over labels, labeller answers and sentiment scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import NEGATIVE, NEUTRAL, POSITIVE, POSITIVE_LABELS, PROMPT
from kanaat.functions.text import strip_space


def normalise_label(raw: Column) -> Column:
    return F.lower(strip_space(raw)).isin(POSITIVE_LABELS).cast("int")


def parse_answer(answer: Column) -> Column:
    """Any '1' or 'evet' in the answer counts as yes."""
    low = F.lower(answer)
    return (F.contains(low, F.lit("1")) | F.contains(low, F.lit("evet"))).cast("int")


def render_prompt(comment: Column, category: Column, description: Column) -> Column:
    parts, rest = [], PROMPT
    fields = {"comment": comment, "category": category, "description": description}
    while "{" in rest:
        text, rest = rest.split("{", 1)
        field, rest = rest.split("}", 1)
        parts += [F.lit(text), fields[field]]
    return F.concat(*parts, F.lit(rest))


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    powers = F.transform(logits, lambda x: F.exp(x - top))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def sentiment_of_probabilities(p_negative: Column, p_positive: Column) -> Column:
    """Positive needs a strict win; a failed scorer (null) is neutral."""
    return F.when(p_negative.isNull() | p_positive.isNull(), NEUTRAL).when(
        p_positive > p_negative, POSITIVE
    ).otherwise(NEGATIVE)


def polarity(p_negative: Column, p_positive: Column) -> Column:
    return F.coalesce(p_positive - p_negative, F.lit(0.0))


def sentiment_of_polarity(value: Column) -> Column:
    return F.when(value > 0, POSITIVE).when(value < 0, NEGATIVE).otherwise(NEUTRAL)


def winning_class(p0: Column, p1: Column) -> Column:
    return F.when(p1 > p0, 1).otherwise(0)


def percent_of(count: Column, target: Column) -> Column:
    return F.when(target > 0, count / target * 100).otherwise(F.lit(0.0))


def seconds_left(elapsed: Column, count: Column, target: Column) -> Column:
    return F.when(count > 0, F.greatest(elapsed / count * target - elapsed, F.lit(0.0))).otherwise(F.lit(0.0))


def clock(seconds: Column) -> Column:
    whole = F.floor(seconds).cast("long")
    hours = F.floor(whole / 3600)
    minutes = F.floor((whole - hours * 3600) / 60)
    return F.format_string("%d:%02d:%02d", hours, minutes, whole - hours * 3600 - minutes * 60)
