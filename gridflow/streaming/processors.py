"""What keyed state does with the rows of a key. Nothing here uses the rest of the package, so that it can be sent as it is."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming import StatefulProcessor


class ProductTotals(StatefulProcessor):
    """One value per (product, salt): accepted orders, rejected ones, and the sum of the accepted prices."""

    def __init__(self, columns, zero):
        self.columns, self.zero = columns, zero

    def init(self, handle):
        self.totals = handle.getValueState("totals", self.columns)

    def handleInitialState(self, key, initialState, timerValues):
        row = initialState.iloc[0]
        self.totals.update((int(row["orders"]), int(row["rejects"]), row["total"]))

    def handleInputRows(self, key, rows, timerValues):
        orders, rejects, total = self.totals.get() if self.totals.exists() else (0, 0, self.zero)
        for part in rows:
            good = part["accepted"].astype(bool)
            orders, rejects = orders + int(good.sum()), rejects + int((~good).sum())
            total = total + sum(part.loc[good, "price_value"], self.zero)
        self.totals.update((orders, rejects, total))
        yield pd.DataFrame({"product": [key[0]], "salt": [key[1]], "orders": [orders], "rejects": [rejects], "total": [total]})

    def close(self):
        pass


PARKED = pa.schema([("seq", pa.int64()), ("orderId", pa.string()), ("product", pa.string()), ("price", pa.string()),
                    ("failures", pa.int32()), ("attempt", pa.int32()), ("since", pa.int64())])
OUTCOME = ("seq long, orderId string, product string, price string, transient_failures int, permanent_error string, "
           "status string, attempts int, retries int, error_reason string, parked_ms long")


def packed(messages):
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, PARKED) as out:
        out.write_table(messages)
    return sink.getvalue().to_pybytes()


def unpacked(stored):
    return pa.ipc.open_stream(stored).read_all()


class ParkedRetries(StatefulProcessor):
    """Many messages per key. Those that fail are kept with their attempt, all that are due at one time together, until a timer
    says that their backoff is over, then tried again; nothing waits outside the state, so a restart forgets none and repeats
    no attempt."""

    def __init__(self, max_retries, backoff_ms, statuses, exhausted):
        self.max_retries, self.backoff_ms, self.exhausted = max_retries, backoff_ms, exhausted
        self.accepted, self.recovered, self.quarantined = statuses

    def init(self, handle):
        self.handle = handle
        self.parked = handle.getMapState("parked", "due long", "messages binary")

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        new = pa.concat_tables([pa.Table.from_pandas(part.assign(attempt=1, since=now), PARKED, preserve_index=False)
                                for part in rows])
        seqs = new["seq"].to_pandas()
        waiting = [unpacked(value[0])["seq"] for value in self.parked.values()]
        fresh = ~seqs.duplicated()
        if waiting:  # the message again, while it waits
            fresh &= ~seqs.isin(pa.chunked_array([c for w in waiting for c in w.chunks], pa.int64()).to_pandas())
        yield from self._tried(new.filter(pa.array(fresh)), now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        due = expiredTimerInfo.getExpiryTimeInMs()
        waiting = unpacked(self.parked.getValue((due,))[0])
        self.parked.removeKey((due,))
        at = PARKED.get_field_index("attempt")
        attempt = pa.array(waiting["attempt"].to_numpy() + 1, pa.int32())
        yield from self._tried(waiting.set_column(at, PARKED.field(at), attempt), timerValues.getCurrentProcessingTimeInMs())

    def _tried(self, messages, now):
        failures, attempt = messages["failures"].to_numpy(), messages["attempt"].to_numpy()
        waits = (attempt <= failures) & (attempt < self.max_retries)
        for number in np.unique(attempt[waits]).tolist():
            self._park(now + number * self.backoff_ms, messages.filter(pa.array(waits & (attempt == number))))
        if not waits.all():
            yield self._outcomes(messages.filter(pa.array(~waits)), now)

    def _park(self, due, messages):
        if self.parked.containsKey((due,)):
            messages = pa.concat_tables([unpacked(self.parked.getValue((due,))[0]), messages])
        self.parked.updateValue((due,), (packed(messages),))
        self.handle.registerTimer(due)

    def _outcomes(self, messages, now):
        rows = messages.to_pandas(integer_object_nulls=True)
        fails, failed = rows["attempt"] <= rows["failures"], rows["failures"] > 0
        return pd.DataFrame({
            "seq": rows["seq"], "orderId": rows["orderId"], "product": rows["product"], "price": rows["price"],
            "transient_failures": rows["failures"], "permanent_error": None,
            "status": np.where(fails, self.quarantined, np.where(failed, self.recovered, self.accepted)),
            "attempts": rows["attempt"], "retries": rows["failures"].clip(upper=self.max_retries),
            "error_reason": np.where(fails, self.exhausted, None), "parked_ms": now - rows["since"]})

    def close(self):
        pass
