"""Files that a run leaves behind.

Everything goes through Hadoop's file systems, so paths may be local or in a
store that only Spark reads.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stats import distribution, heavy_hitters
from ..operators.validate import with_errors
from .shards import joined, write_shards

FIELDS = ["id", "version", "split", "source", "market", "instrument", "timeframe", "timestamp_context", "system_prompt", "context", "reasoning", "decision", "outcome", "tags", "quality_score"]


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, where = _fs(spark, path)
    fs.mkdirs(where.getParent())
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def as_json(examples: DataFrame) -> DataFrame:
    """``value``: an example as a JSON object with its keys in order; null fields are absent, non-ASCII stays."""
    return examples.select(F.to_json(F.struct(*[c for c in FIELDS if c in examples.columns])).alias("value"))


def write_jsonl(examples: DataFrame, path: str, single_file: bool = False) -> tuple[int, int]:
    """(written, skipped): valid examples as lines of JSON in order of ``ord``; the others are left out.

    ``path`` is a folder of sorted shards with a manifest.  ``single_file``
    makes one file of them, for sets of a size that a person reads.
    """
    checked = with_errors(examples)
    value = F.when(F.size("errors") == 0, F.to_json(F.struct(*[c for c in FIELDS if c in examples.columns])))
    order = [c for c in ("ord",) if c in checked.columns]
    rows = checked.select(value.alias("value"), *order)
    target = f"{path}.parts" if single_file else path
    told = write_shards(rows, target, order)
    if single_file:
        joined(examples.sparkSession, target, path)
    return told["rows"], told["skipped"]


def stats_markdown(stats: dict, train_path: str, val_path: str) -> str:
    """The run's statistics as Markdown tables."""
    verdicts = stats["verdicts"]
    ended = sum(n for v, n in verdicts.items() if v != "none")
    rate = f"{verdicts.get('WIN', 0) / ended * 100:.1f}%" if ended else "N/A (no outcome data)"
    table = lambda head, rows: "\n".join([f"| {' | '.join(head)} |", "|" + "---|" * len(head), *(f"| {' | '.join(map(str, r))} |" for r in rows)])
    parts = [
        "# Dataset statistics",
        "## Stages",
        table(("Stage", "Count"), [("Total input examples", stats["total_input"]), ("After dedup", stats["after_dedup"]), ("After quality filter", stats["after_quality_filter"]), ("After outcome filter", stats["after_outcome_filter"]), ("Final", stats["final"])]),
        "## Splits",
        table(("Split", "Count", "File"), [("train", stats["train"], f"`{train_path}`"), ("val", stats["val"], f"`{val_path}`")]),
        "## Quality",
        f"- Mean quality score: **{stats['quality_mean']:.4f}**\n- Win rate (examples with outcome): **{rate}**",
        "## Sources",
        table(("Source", "Count"), sorted(stats["sources"].items())),
        "## Verdicts",
        table(("Verdict", "Count"), sorted(verdicts.items())),
    ]
    return "\n\n".join(parts) + "\n"


def export_dataset(labeled: DataFrame, stats: dict, out_dir: str, single_file: bool = False) -> dict:
    """Train and val files and statistics; rows of other splits are not exported."""
    train, val, report = (f"{out_dir}/{n}" for n in ("sft_dataset.jsonl", "sft_dataset.val.jsonl", "stats.md"))
    result = {"train_path": train, "val_path": val, "stats_path": report}
    for name, path in (("train", train), ("val", val)):
        result[f"{name}_written"], result[f"{name}_skipped"] = write_jsonl(labeled.where(F.col("split") == name), path, single_file)
    write_text(labeled.sparkSession, report, stats_markdown(stats, train, val))
    return result


def dataset_card(labeled: DataFrame, exact: bool = True, instruments: int = 1000) -> dict:
    """Counts, distributions, dates and quality statistics of all splits; one pass per distribution.

    Exact, each instrument is a row on the driver.  Else the card names about
    the ``instruments`` most frequent and takes quartiles from sketches, with
    the errors of :func:`heavy_hitters` and :func:`distribution`.
    """
    counts = lambda c: {r[0]: r[1] for r in labeled.groupBy(c.alias("k")).agg(F.count("*")).orderBy("k").collect()}
    dates = labeled.agg(F.min("timestamp_context"), F.max("timestamp_context")).first()
    quality = distribution(labeled, F.col("quality_score"), exact=exact).first()
    named = counts(F.col("instrument")) if exact else {r["item"]: r["count"] for r in heavy_hitters(labeled, F.col("instrument"), instruments).collect()}
    return {
        "schema_version": "1.0",
        "total_examples": quality["n"],
        "splits": counts(F.col("split")),
        "sources": counts(F.coalesce("source", F.lit("unknown"))),
        "instruments": named,
        "verdicts": counts(F.coalesce(F.col("outcome.verdict"), F.lit("none"))),
        "date_range": list(dates),
        "quality_score": {k: quality[k] for k in ("mean", "std", "p25", "p50", "p75", "least", "most")},
    }


def write_dataset_card(labeled: DataFrame, path: str, exact: bool = True) -> dict:
    card = dataset_card(labeled, exact)
    write_text(labeled.sparkSession, path, json.dumps(card, indent=2, ensure_ascii=False) + "\n")
    return card


REVIEW_COLUMNS = ["id", "source", "instrument", "timestamp", "reasoning_excerpt", "decision_raw", "outcome_verdict", "quality_score", "flag_reason"]


def review_queue(flagged: DataFrame) -> DataFrame:
    """Nine columns of the rows with a ``flag_reason``."""
    return flagged.where("flag_reason is not null").select(
        "id", "source", "instrument",
        F.col("timestamp_context").alias("timestamp"),
        F.substring("reasoning", 1, 200).alias("reasoning_excerpt"),
        F.to_json("decision").alias("decision_raw"),
        F.col("outcome.verdict").alias("outcome_verdict"),
        "quality_score", "flag_reason",
    )


def write_review_queue(flagged: DataFrame, path: str) -> None:
    review_queue(flagged).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def preview(examples: DataFrame, n: int = 2, width: int = 120) -> DataFrame:
    """The first ``n`` examples without the system prompt, long texts cut."""
    out = examples.orderBy("ord").limit(n) if "ord" in examples.columns else examples.limit(n)
    for name, kind in out.drop("system_prompt", "ord").dtypes:
        if kind == "string":
            out = out.withColumn(name, F.when(F.length(name) > width, F.concat(F.left(F.col(name), F.lit(width)), F.lit("..."))).otherwise(F.col(name)))
    return out.drop("system_prompt", "ord")
