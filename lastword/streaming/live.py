"""Counters of a running stream, taken from the batches' own runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQueryListener

from lastword.operators import ingest as ing

NAME = "ingest"


def watched(feed: DataFrame, name: str = NAME) -> DataFrame:
    """The judged feed, whose counters are observed while its rows pass: no further action, no further read."""
    return ing.judge(feed).observe(name, *ing.counter_columns())


class LiveCounters(StreamingQueryListener):
    """Adds up what the batches of a watched stream report; `cursor` is the highest so far."""

    def __init__(self, cursor: int = -1, name: str = NAME):
        self.name = name
        self.totals = dict.fromkeys(ing.COUNTED, 0) | {"cursor": cursor}

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            for one in ing.COUNTED:
                self.totals[one] += row[one]
            self.totals["cursor"] = max(self.totals["cursor"], row["cursor"])

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
