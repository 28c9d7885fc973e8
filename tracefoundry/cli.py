"""Command line: posts and fills to a dataset."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from .plans.dataset import LabelOptions, all_examples, fill_examples, label, post_examples
from .sinks.files import export_dataset, preview
from .sources.fills import read_fills  # noqa: F401  part of the public surface

SAMPLES = Path(__file__).parent / "samples"


def parser() -> argparse.ArgumentParser:
    # fixed values: names and defaults of the options, but for --shards
    p = argparse.ArgumentParser(prog="tracefoundry", description=__doc__)
    flag = argparse.BooleanOptionalAction
    p.add_argument("--demo", action="store_true", help="use bundled samples for inputs that are not given")
    p.add_argument("--tweets", metavar="PATH", help="posts: a JSON array")
    p.add_argument("--trades", metavar="PATH", help="fills: a CSV with header")
    p.add_argument("--out-dir", metavar="DIR", default="out")
    p.add_argument("--min-r", type=float)
    p.add_argument("--keep-losers", action=flag, default=True)
    p.add_argument("--min-quality", type=float, default=0.0)
    p.add_argument("--val-fraction", type=float, default=0.15)
    p.add_argument("--use-llm", action="store_true", help="use the expander that the program was started with")
    p.add_argument("--shards", action="store_true", help="write folders of sorted shards with a manifest instead of single files")
    return p


def summary(result: dict, stats: dict) -> str:
    ended = sum(n for v, n in stats["verdicts"].items() if v != "none")
    rate = f"{stats['verdicts'].get('WIN', 0) / ended * 100:.1f}%" if ended else "N/A"
    rows = [
        ("Total input examples", stats["total_input"]), ("After dedup", stats["after_dedup"]), ("After quality filter", stats["after_quality_filter"]),
        ("After outcome filter", stats["after_outcome_filter"]), ("Final examples", stats["final"]), ("  train", stats["train"]), ("  val", stats["val"]),
        ("Mean quality score", f"{stats['quality_mean']:.4f}"), ("Win rate", rate), ("Sources", dict(sorted(stats["sources"].items()))),
        ("Train file", f"{result['train_path']} ({result['train_written']})"), ("Val file", f"{result['val_path']} ({result['val_written']})"), ("Statistics", result["stats_path"]),
    ]
    return "\n".join(f"{name:<22}: {value}" for name, value in rows)


def _loaded(spark, path, read):
    """Examples of one source; a missing or unreadable file is a warning."""
    try:
        rows = read(spark, path).persist()
        rows.count()
        return rows
    except Exception as error:
        print(f"warning: {path} could not be read: {str(error).splitlines()[0]}", file=sys.stderr)
        return None


def main(argv: list[str] | None = None, spark: SparkSession | None = None, expander=None) -> int:
    a = parser().parse_args(argv)
    tweets = a.tweets or (str(SAMPLES / "posts.json") if a.demo else None)
    trades = a.trades or (str(SAMPLES / "fills.csv") if a.demo else None)
    if not (tweets or trades):
        print("error: give --demo, --tweets or --trades", file=sys.stderr)
        return 1
    spark = spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    parts = []
    if tweets:
        parts.append(_loaded(spark, tweets, lambda s, p: post_examples(s, p, expander if a.use_llm else None)))
    if trades:
        parts.append(_loaded(spark, trades, fill_examples))
    parts = [p for p in parts if p is not None and not p.isEmpty()]
    if not parts:
        print("error: no examples were loaded", file=sys.stderr)
        return 1
    labeled, stats = label(all_examples(*parts), LabelOptions(a.min_quality, a.keep_losers, a.min_r, a.val_fraction))
    if not stats["final"]:
        print("error: all examples were filtered out", file=sys.stderr)
        return 1
    result = export_dataset(labeled, stats, a.out_dir, single_file=not a.shards)
    print(summary(result, stats))
    from pyspark.sql import functions as F

    for row in preview(labeled.where(F.col("split") == "train")).toJSON().collect():
        print(json.dumps(json.loads(row), indent=2, ensure_ascii=False))
    return 0


if __name__ == "__main__":
    sys.exit(main())
