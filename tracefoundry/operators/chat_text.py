"""Chat templates of model families for finished examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAMILIES = ("qwen", "llama3", "mistral")


def turn_text(family: str, role: Column, text: Column) -> Column:
    """One turn in the family's template."""
    if family == "qwen":
        return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))
    if family == "llama3":
        return F.concat(F.lit("<|start_header_id|>"), role, F.lit("<|end_header_id|>\n\n"), text, F.lit("<|eot_id|>"))
    if family == "mistral":
        return F.when(role == "assistant", F.concat(F.lit(" "), text, F.lit("</s>"))).otherwise(F.concat(F.lit("[INST] "), text, F.lit(" [/INST]")))
    raise ValueError(f"family has to be one of {FAMILIES}")


def opening(family: str) -> str:
    return {"qwen": "", "llama3": "<|begin_of_text|>", "mistral": "<s>"}[family]


def with_formatted_text(examples: DataFrame, family: str) -> DataFrame:
    """``examples`` with ``formatted_text``: system prompt, context as user, reasoning and decision as assistant."""
    answer = F.concat_ws("\n\n", "reasoning", F.to_json("decision"))
    if family == "mistral":
        parts = [turn_text(family, F.lit("user"), F.concat_ws("\n\n", "system_prompt", "context")), turn_text(family, F.lit("assistant"), answer)]
    else:
        parts = [turn_text(family, F.lit(r), t) for r, t in (("system", F.col("system_prompt")), ("user", F.col("context")), ("assistant", answer))]
    return examples.withColumn("formatted_text", F.concat(F.lit(opening(family)), *parts))


def conversation_text(turns: DataFrame, family: str = "qwen") -> DataFrame:
    """(conv_id, n_turns, formatted_text) of rows (conv_id, turn, role, text)."""
    line = turn_text(family, F.col("role"), F.coalesce("text", F.lit("")))
    rows = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))).alias("lines"))
    return rows.select("conv_id", F.size("lines").cast("long").alias("n_turns"), F.concat(F.lit(opening(family)), F.array_join(F.col("lines.line"), "")).alias("formatted_text"))
