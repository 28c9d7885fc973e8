"""The live source as a stream, with a service in files: posts, a clock, and a mark for each request."""

import os
import uuid

import pytest

from tracefoundry.sources.post_api import PostApiSource, PostApiStreamReader


def service(folder):
    folder = str(folder)

    class Stub(PostApiSource):
        @classmethod
        def name(cls):
            return "stub_posts"

        def now(self):
            return float(open(f"{folder}/clock").read())

        def between(self, account, token, after, up_to):
            open(f"{folder}/asked/{account}-{uuid.uuid4().hex}", "w").close()
            # one post each ten seconds, up to the clock
            for t in range(0, int(self.now()) + 1, 10):
                if after < t <= up_to:
                    yield (f"{account}-{t}", account.upper(), f"@{account}", str(t), "btc")

    return Stub


def run(spark, folder, now, accounts="a,b,c"):
    with open(f"{folder}/clock", "w") as f:
        f.write(str(now))
    before = len(os.listdir(f"{folder}/asked"))
    source = spark.readStream.format("stub_posts").option("token", "t").option("accounts", accounts).option("requests", 4).option("interval", 200).load()
    q = source.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start()
    q.awaitTermination()
    return len(os.listdir(f"{folder}/asked")) - before


def test_restarts_read_nothing_twice_and_leave_nothing_out(spark, tmp_path):
    (tmp_path / "asked").mkdir()
    spark.dataSource.register(service(tmp_path))
    # slots of 50 s: 0 a, 1 b, 2 c, 3 a ...
    asked = [run(spark, str(tmp_path), now) for now in (120, 130, 260, 1000)]
    assert asked == [2, 0, 3, 3]
    rows = [(r["author"], int(r["timestamp"])) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    # at 1000 the slot is 20: its own turn is c's, slot 19 b's and 18 a's
    want = [(a, t) for a, end in (("A", 900), ("B", 950), ("C", 1000)) for t in range(0, end + 1, 10)]
    assert len(rows) == len(set(rows)) and sorted(rows) == sorted(x for x in want if x in rows or x[1] > 0)


def test_timetable_keeps_to_the_limit():
    """In any order of batches, the spans of an account meet end to end, and a batch asks no more than slots went by."""
    options = {"token": "t", "accounts": ",".join("abcdefg"), "requests": "3", "interval": "30", "since": "100"}
    source = PostApiSource(options)
    reader = PostApiStreamReader(source)
    at, ends = reader.initialOffset(), {}
    for slot in (10, 11, 13, 13, 40, 41, 100):
        parts = reader.partitions(at, {"slot": slot})
        assert len(parts) <= slot - at["slot"]
        for n, p in enumerate(parts):
            account, after, up_to, wait = p.value
            assert ends.get(account, after) == after < up_to <= slot * 10 and wait == n // 3 * 30
            ends[account] = up_to
        at = {"slot": slot}
    assert len(ends) == 7 and min(ends.values()) >= 940
    with pytest.raises(NotImplementedError):
        source.between("a", "t", 0, 1)
