"""Claims with heartbeats, expiry and takeover as a stateful stream, and the same rule over a table.

An event is (slug, worker, at, n): a worker asks for a slug or beats for it; n orders events of one time. A free slug goes to the worker; its own
events extend the lease; those of others are refused while it lasts, that is until ``lease`` seconds after the owner's last event. From then on the
first event of any worker claims it again (a takeover if the worker is another one), so a late beat of the former owner is refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUT = "slug string, worker string, at long, n long, verdict string, owner string"
STATE = "owner string, beat long"


def settle(owner: str | None, beat: int | None, worker: str, at: int, lease: int) -> tuple[str, str, int]:
    """Verdict of one event, and the owner and its last beat after it; times in milliseconds."""
    if owner is None:
        return "claimed", worker, at
    if at - beat >= lease:
        return ("claimed" if worker == owner else "taken over"), worker, at
    if worker == owner:
        return "beat", owner, max(at, beat)
    return "refused", owner, beat


class ClaimProcessor(StatefulProcessor):
    """State per slug: owner and last beat; a timer at the end of the lease tells that it expired.

    Events of a batch are settled in order of time. The state stays after expiry, so a takeover still knows whom it replaces, until ``forget`` more
    milliseconds have passed.
    """

    def __init__(self, lease: int, forget: int):
        self.lease, self.forget = lease, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("claim", STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        owner, beat = self.state.get() if self.state.exists() else (None, None)
        out = []
        events = pd.concat(list(rows)).sort_values(["ms", "n"])
        for worker, ms, n in zip(events["worker"], events["ms"], events["n"], strict=True):
            verdict, owner, beat = settle(owner, beat, worker, int(ms), self.lease)
            out.append((key[0], worker, int(ms), int(n), verdict, owner))
        self.state.update((owner, int(beat)))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(max(int(beat) + self.lease, timerValues.getCurrentWatermarkInMs() + 1))
        yield pd.DataFrame(out, columns=["slug", "worker", "at", "n", "verdict", "owner"])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        owner, beat = self.state.get()
        now = expiredTimerInfo.getExpiryTimeInMs()
        if now >= beat + self.lease + self.forget:
            self.state.clear()
            return
        self.handle.registerTimer(max(beat + self.lease + self.forget, now + 1))
        yield pd.DataFrame([(key[0], owner, beat + self.lease, -1, "expired", None)], columns=["slug", "worker", "at", "n", "verdict", "owner"])

    def close(self) -> None:
        pass


def claims_stream(events: DataFrame, lease_s: int = 1800, late: str = "0 seconds", forget_s: int = 86_400) -> DataFrame:
    """slug, worker, at (milliseconds), n, verdict (claimed, beat, taken over, refused, expired), owner.

    events: a stream of slug, worker, at (timestamp), n. Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    seen = events.withWatermark("at", late).withColumn("ms", F.unix_millis("at"))
    return seen.groupBy("slug").transformWithStateInPandas(ClaimProcessor(lease_s * 1000, forget_s * 1000), OUT, "append", "eventTime")


def claims_table(events: DataFrame, lease_s: int = 1800) -> DataFrame:
    """The same verdicts for a table of events, without the rows of expiries: slug, worker, at (milliseconds), n, verdict, owner.

    A slug's events come as a sorted stream of batches, and only the owner and its last beat are kept of them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slug = owner = beat = None
        first = True
        for pdf in batches:
            verdicts, owners = [], []
            for s, worker, ms in zip(pdf["slug"], pdf["worker"], pdf["at"], strict=True):
                if first or s != slug:
                    slug, owner, beat, first = s, None, None, False
                verdict, owner, beat = settle(owner, beat, worker, int(ms), lease_s * 1000)
                verdicts.append(verdict)
                owners.append(owner)
            yield pdf.assign(verdict=verdicts, owner=owners)

    rows = events.select("slug", "worker", F.unix_millis("at").alias("at"), F.col("n").cast("long").alias("n"))
    return rows.repartition("slug").sortWithinPartitions("slug", "at", "n").mapInPandas(run, OUT)
