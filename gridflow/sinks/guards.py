"""What goes around a writer: retries, a second store, skipping empty batches."""

import logging
import time

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException

log = logging.getLogger(__name__)


def linear(step):
    """Waits of step, 2 * step, 3 * step ..."""
    return lambda attempt: step * attempt


def doubling(first):
    """Waits of first, 2 * first, 4 * first ..."""
    return lambda attempt: first * 2 ** (attempt - 1)


#: What a failing store or a failing Spark job raises.
WRITE_ERRORS = (OSError, Py4JJavaError, PySparkException)


def with_retry(write, attempts=3, wait=linear(0.1), retry_on=WRITE_ERRORS, never_on=(AnalysisException,),
               sleep=time.sleep):
    """Run a writer up to `attempts` times. The last error leaves, so the batch fails and
    the engine runs it again; errors outside `retry_on`, and plans that cannot be analysed,
    leave at once."""
    def guarded(batch_df, batch_id):
        for attempt in range(1, attempts + 1):
            try:
                return write(batch_df, batch_id)
            except retry_on as error:
                if attempt == attempts or isinstance(error, never_on):
                    raise
                log.warning("batch %s, attempt %d of %d: %s", batch_id, attempt, attempts, error)
                sleep(wait(attempt))
    return guarded


def skip_empty(write):
    """Leave out batches without rows. The batch is kept while it is looked at and written,
    so it is computed once."""
    def guarded(batch_df, batch_id):
        rows = batch_df.persist()
        try:
            if not rows.isEmpty():
                write(rows, batch_id)
        finally:
            rows.unpersist()
    return guarded


class FanOut:
    """Writes to a required store and, while it works, to an optional one.

    An error of the required store fails the batch. The first error of the optional one is
    counted, and it gets no further batches.
    """

    def __init__(self, required, optional):
        self.required, self.optional = required, optional
        self.optional_errors, self.optional_active = 0, True

    def __call__(self, batch_df, batch_id):
        rows = batch_df.persist()
        try:
            self.required(rows, batch_id)
            if self.optional_active:
                try:
                    self.optional(rows, batch_id)
                except Exception as error:  # best effort by design
                    self.optional_errors += 1
                    self.optional_active = False
                    log.warning("optional store dropped after batch %s: %s", batch_id, error)
        finally:
            rows.unpersist()
