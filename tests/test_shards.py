"""Sorted shards: whole runs or nothing, and manifests that agree with the files."""

import bisect
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from tracefoundry.operators.stats import ACCURACY, TRACKED
from tracefoundry.sinks.files import dataset_card
from tracefoundry.sinks.shards import joined, read_manifest, write_shards


def lines(spark, n, salt=""):
    rows = spark.range(n).withColumn("at", F.xxhash64("id")).repartition(5)
    return rows.select("at", F.when(F.col("id") % 10 != 3, F.concat(F.lit(f'{{"id": "é{salt}'), "id", F.lit('"}'))).alias("value"))


def held(path):
    """What the shards hold, in order of their names, and the manifest."""
    told = read_manifest(path)
    text = b""
    for shard in told["shards"]:
        block = open(os.path.join(path, shard["name"]), "rb").read()
        assert (len(block), hashlib.sha256(block).hexdigest(), block.count(b"\n")) == (shard["bytes"], shard["sha256"], shard["rows"])
        text += block
    return text.decode().splitlines(), told


def test_shards_are_ranges_and_the_manifest_agrees(spark, tmp_path):
    path = str(tmp_path / "out" / "deep")
    told = write_shards(lines(spark, 1000), path, ["at"], 6)
    got, again = held(path)
    assert told == again and (told["rows"], told["skipped"], len(told["shards"])) == (900, 100, 6)
    want = [r["value"] for r in lines(spark, 1000).where("value is not null").orderBy("at").collect()]
    assert got == want and sorted(os.listdir(path)) == sorted(["_manifest.json", *(s["name"] for s in told["shards"])])
    # another run takes its place, and leaves none of the old files
    write_shards(lines(spark, 20, "x"), path, ["at"], 2)
    got, told = held(path)
    assert len(got) == told["rows"] == 18 and set(os.listdir(path)) == {"_manifest.json", *(s["name"] for s in told["shards"])}
    joined(spark, path, str(tmp_path / "one.jsonl"))
    assert (tmp_path / "one.jsonl").read_text(encoding="utf-8").splitlines() == got and not os.path.exists(path)


def test_a_failed_run_leaves_what_was_there(spark, tmp_path):
    path = str(tmp_path / "out")
    write_shards(lines(spark, 50), path, ["at"], 2)
    before, names = held(path), set(os.listdir(path))
    broken = lines(spark, 1000).withColumn("value", F.when(F.col("value").contains("777"), F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken"):
        write_shards(broken, path, [], None)
    assert held(path) == before and set(os.listdir(path)) == names


def test_no_rows(spark, tmp_path):
    told = write_shards(lines(spark, 0), str(tmp_path / "none"), ["at"])
    assert told == {"rows": 0, "skipped": 0, "shards": []} == read_manifest(str(tmp_path / "none"))
    assert json.loads((tmp_path / "none" / "_manifest.json").read_text())["rows"] == 0


def test_card_from_sketches_keeps_its_errors(spark):
    """Instruments of a long tail and scores of many values, within the bounds that the sketches state."""
    n = 40_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("BTC")).when(F.col("id") % 7 == 1, F.lit(None)).otherwise(F.concat(F.lit("S"), F.floor(F.sqrt("id")))).alias("instrument"),
        (F.xxhash64("id") % 100_003 / 100_003.0).alias("quality_score"), F.lit("train").alias("split"), F.lit("s").alias("source"), F.lit("2025").alias("timestamp_context"),
        F.struct(F.lit("WIN").alias("verdict")).alias("outcome"),
    )
    exact, near = dataset_card(rows), dataset_card(rows, exact=False, instruments=20)
    scores = sorted(r[0] for r in rows.select("quality_score").collect())
    for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        got = near["quality_score"][name]
        low, high = bisect.bisect_left(scores, got), bisect.bisect_right(scores, got)
        assert low - n / ACCURACY - 1 <= q * n <= high + n / ACCURACY + 1
    slack = 3.5 * n / TRACKED
    assert len(near["instruments"]) == 20 and all(exact["instruments"][k] <= c <= exact["instruments"][k] + slack for k, c in near["instruments"].items())
    missed = max(c for k, c in exact["instruments"].items() if k not in near["instruments"])
    assert missed <= min(near["instruments"].values()) + slack
    assert {k: v for k, v in near.items() if k not in ("instruments", "quality_score")} == {k: v for k, v in exact.items() if k not in ("instruments", "quality_score")}
