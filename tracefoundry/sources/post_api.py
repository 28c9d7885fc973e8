"""A live source of posts for the Python Data Source API, in batches and as a stream.

The stream keeps to a service's limit of requests by a timetable: time is cut
into slots, a request each, and slot n is the turn of account n modulo their
number, whose posts it reads up to the slot's beginning.  So an offset is a
slot, found from the clock alone, and what lies between two offsets is a span
of time for each account.  A query that goes on from its checkpoint reads
nothing twice and leaves nothing out, whatever its reader remembers.
"""

from __future__ import annotations

import time

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# fixed values: the service's limit of requests
REQUESTS = 15
INTERVAL_SECONDS = 900


class PostApiSource(DataSource):
    """Interface of a live post fetcher; the base class knows no network.

    Options: ``token``, ``accounts`` (comma-separated) and for streams
    ``requests`` in ``interval`` seconds, ``since`` (seconds since the epoch,
    from which a round of turns before is read) and ``lag``, seconds until
    the service shows a post.  A subclass implements :meth:`fetch` for
    batches and :meth:`between` for streams.
    """

    @classmethod
    def name(cls) -> str:
        return "post_api"

    def schema(self) -> str:
        return "id string, author string, handle string, timestamp string, text string"

    def fetch(self, account: str, token: str):
        """All posts of an account, as (id, author, handle, timestamp, text)."""
        raise NotImplementedError("subclass PostApiSource and implement fetch()")

    def between(self, account: str, token: str, after: float, up_to: float):
        """Posts with ``after`` < seconds since the epoch <= ``up_to``, the same at each call.  One request."""
        raise NotImplementedError("subclass PostApiSource and implement between()")

    def now(self) -> float:
        return time.time()

    def reader(self, schema) -> DataSourceReader:
        return PostApiReader(self)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PostApiStreamReader(self)


def _accounts(options: dict) -> list[str]:
    if not options.get("token"):
        raise OSError("the option 'token' has to hold a bearer token")
    return [a.strip() for a in options.get("accounts", "").split(",") if a.strip()]


class PostApiReader(DataSourceReader):
    def __init__(self, source: PostApiSource):
        self.source, self.options = source, dict(source.options)
        self.accounts = _accounts(self.options)

    def partitions(self):
        return [InputPartition(a) for a in self.accounts]

    def read(self, partition):
        yield from self.source.fetch(partition.value, self.options["token"])


class PostApiStreamReader(DataSourceStreamReader):
    """One request for each account whose turn came since the last batch.

    After a long pause more accounts than ``requests`` may have had their
    turn; those beyond wait in their tasks for the intervals that come.  A
    task that is tried again repeats its request.
    """

    def __init__(self, source: PostApiSource):
        self.source, self.options = source, dict(source.options)
        self.accounts = _accounts(self.options)
        self.requests = int(self.options.get("requests", REQUESTS))
        self.interval = float(self.options.get("interval", INTERVAL_SECONDS))
        self.slot = self.interval / self.requests

    def initialOffset(self) -> dict:
        return {"slot": int(float(self.options.get("since", 0)) // self.slot)}

    def latestOffset(self) -> dict:
        settled = self.source.now() - float(self.options.get("lag", 0))
        return {"slot": max(int(settled // self.slot), self.initialOffset()["slot"])}

    def _turn(self, account: int, slot: int) -> int:
        """The account's last slot up to ``slot``."""
        return slot - (slot - account) % len(self.accounts)

    def partitions(self, start: dict, end: dict):
        spans = [(name, self._turn(i, start["slot"]), self._turn(i, end["slot"])) for i, name in enumerate(self.accounts)]
        due = sorted((till, name, had) for name, had, till in spans if till > had)
        return [InputPartition((name, had * self.slot, till * self.slot, n // self.requests * self.interval)) for n, (till, name, had) in enumerate(due)]

    def read(self, partition):
        account, after, up_to, wait = partition.value
        time.sleep(wait)
        yield from self.source.between(account, self.options["token"], after, up_to)

    def commit(self, end: dict) -> None:
        pass
