"""Volume counters of running streams."""

from pyspark.sql.streaming import StreamingQueryListener


class VolumeListener(StreamingQueryListener):
    """Rows read and micro-batches with rows, from the engine's own progress reports."""

    def __init__(self):
        self.total_events, self.batch_count = 0, 0

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        rows = event.progress.numInputRows
        if rows:
            self.total_events += rows
            self.batch_count += 1

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
