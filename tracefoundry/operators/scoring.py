"""Quality scores of examples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import rounded, word_count
from .answers import ask, call_each

# fixed values: source tiers, verdict scores and weights of the live score
SOURCE_TIER = {"own_journal": 1.0, "kol_post": 0.7, "research_note": 0.75, "chat_log": 0.45, "on_chain": 0.60, "synthetic": 0.20}
VERDICT_SCORE = {"WIN": 1.0, "SCRATCH": 0.6, "LOSS": 0.5, "EXPIRED": 0.4}
WEIGHTS = {"outcome": 0.35, "source_tier": 0.25, "specificity": 0.25, "reasoning_depth": 0.15}
# fixed values: weights and tiers of the planned score with a judge
JUDGE_WEIGHTS = {"outcome": 0.35, "consistency": 0.30, "source_tier": 0.20, "specificity": 0.15}
JUDGE_TIER = {"own_journal": 1.0, "research_note": 0.8, "kol_post": 0.6, "chat_log": 0.4, "synthetic": 0.2}


def lookup(key: Column, table: dict[str, float], default: float) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def tier(source: Column, table: dict[str, float] = SOURCE_TIER) -> Column:
    return lookup(source, table, 0.2)


def outcome_score(verdict: Column) -> Column:
    return lookup(verdict, VERDICT_SCORE, 0.3)


def specificity(entry: Column, stop: Column, target: Column) -> Column:
    """Share of the three levels that are there (conditions)."""
    return (entry.cast("int") + stop.cast("int") + target.cast("int")) / F.lit(3.0)


# fixed values: the steps of the reasoning's length
def depth(text: Column) -> Column:
    words = word_count(F.coalesce(text, F.lit("")))
    return F.when(words < 20, 0.1).when(words < 50, 0.4).when(words <= 400, 1.0).when(words <= 600, 0.8).otherwise(0.6)


def composite(outcome: Column, source_tier: Column, specific: Column, deep: Column) -> Column:
    """Weighted sum in a fixed order of additions, clamped to [0, 1], four decimals."""
    w = WEIGHTS
    total = F.lit(w["outcome"]) * outcome + F.lit(w["source_tier"]) * source_tier + F.lit(w["specificity"]) * specific + F.lit(w["reasoning_depth"]) * deep
    return rounded(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)), 4)


def example_specificity() -> Column:
    filled = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    d = F.col("decision")
    return specificity(filled(d["entry_zone"]), d["invalidation"].isNotNull(), filled(d["targets"]))


def with_quality(examples: DataFrame) -> DataFrame:
    source = F.coalesce("source", F.lit("synthetic"))
    return examples.withColumn("quality_score", composite(outcome_score(F.col("outcome.verdict")), tier(source), example_specificity(), depth(F.col("reasoning"))))


def judged_quality(outcome: Column, consistency: Column, source: Column, specific: Column, weights: dict[str, float] | None = None) -> Column:
    """The planned score: a judge's 1 to 5 joins the signals, normalised to [0, 1]; null counts as 0."""
    w = weights or JUDGE_WEIGHTS
    if abs(sum(w.values()) - 1) > 1e-9:
        raise ValueError("weights have to sum to 1")
    judge = F.coalesce((consistency - 1) / 4.0, F.lit(0.0))
    total = w["outcome"] * outcome + w["consistency"] * judge + w["source_tier"] * tier(source, JUDGE_TIER) + w["specificity"] * specific
    return rounded(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)), 4)


def judge_scores(examples: DataFrame, judge: Callable[[dict], int | None], kept: str | None = None, name: str = "judge") -> DataFrame:
    """``examples`` with ``consistency``, an injected judge's 1 to 5 of each; null where it fails or says anything else.

    ``judge`` gets one record (context, reasoning, direction) at a time.  With
    ``kept``, a Parquet path, scores are kept there under ``name`` and asked for once.
    """
    record = ["context", "reasoning", "__direction"]
    rows = examples.withColumn("__direction", F.col("decision.direction"))

    def call(r: dict) -> int | None:
        return judge({"context": r["context"], "reasoning": r["reasoning"], "direction": r["__direction"]})

    made = call_each(rows, record, call, "consistency", "int") if kept is None else ask(rows, record, call, kept, name, "consistency", "int")
    score = F.col("consistency")
    return made.withColumn("consistency", F.when(score.between(1, 5), score)).drop("__direction", "consistency_error")
