"""Progress of streams: a listener that keeps and prints what each batch took in."""

from __future__ import annotations

import sys

from pyspark.sql.streaming import StreamingQueryListener


class Progress(StreamingQueryListener):
    """Totals and a line for each batch. spark.streams.addListener(Progress())."""

    def __init__(self, out=sys.stderr):
        self.out, self.batches, self.rows = out, 0, 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            self.batches, self.rows = self.batches + 1, self.rows + p.numInputRows
            print(f"batch {p.batchId}: {p.numInputRows} changes, {p.processedRowsPerSecond:.0f} a second; {self.rows} so far", file=self.out)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
