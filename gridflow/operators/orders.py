"""The order flow: check, resolve retries, audit, running average, indicators."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V
from ..functions import average, try_number
from ..schemas import AUDIT_STEP
from .running import running_totals

PRICE_TYPE = "double"


def classify(orders, price_type=PRICE_TYPE):
    """Adds `price_value`, the price as a number, and `error_reason`, null for a valid order.

    The first rule that fails gives the reason. Sign and finiteness are judged on the number
    as it was sent, before it takes `price_type`. Prices that are not finite are refused:
    one of them would spoil every average after it. With a decimal type, for exact sums, a
    price too large for it is refused with that reason.

    Both come out of `inline`, through which the optimizer moves no filter: it would
    otherwise repeat the parsing and the rules in every condition on the outcome.
    """
    value = try_number(F.col("price"), price_type)
    reason = _error(try_number(F.col("price")), value, price_type)
    return orders.select("*", F.inline(F.array(F.struct(value.alias("price_value"), reason.alias("error_reason")))))


def _error(as_double: Column, value: Column, price_type) -> Column:
    infinite = as_double.isin(float("inf"), float("-inf")) | F.isnan(as_double)
    return (
        F.when(F.col("orderId").isNull() | F.col("price").isNull(), V.REASON_MALFORMED)
        .when(infinite, V.REASON_NOT_FINITE)
        .when(as_double.isNull(), F.format_string(V.REASON_NOT_NUMERIC, F.col("price").cast("string")))
        .when(as_double < 0, F.format_string(V.REASON_NEGATIVE, F.format_string("%.2f", as_double)))
        .when(value.isNull(), F.lit(f"price does not fit {price_type}"))
        .when(F.coalesce(F.col("permanent_error"), F.lit("")) != "",
              F.format_string(V.REASON_FORCED, F.col("permanent_error")))
    )


def resolve(orders, max_retries=V.MAX_RETRIES, price_type=PRICE_TYPE):
    """Status, attempts and error of each order after its transient failures.

    A permanent error ends it at the first attempt. Otherwise f failures below
    `max_retries` are recovered in attempt f + 1, more use the retries up.
    """
    checked = classify(orders, price_type)
    failures = F.greatest(F.coalesce("transient_failures", F.lit(0)), F.lit(0))
    permanent, exhausted = F.col("error_reason").isNotNull(), failures >= max_retries
    return checked.withColumns({
        "retries": F.when(permanent, 0).otherwise(F.least(failures, F.lit(max_retries))),
        "status": F.when(permanent | exhausted, V.QUARANTINED)
                   .when(failures > 0, V.RECOVERED).otherwise(V.ACCEPTED),
        "attempts": F.when(permanent, 1).when(exhausted, max_retries).otherwise(failures + 1),
        "error_reason": F.when(permanent, F.col("error_reason"))
                         .when(exhausted, V.REASON_EXHAUSTED % max_retries),
        "_permanent": permanent,
    })


def is_accepted() -> Column:
    return F.col("status") != V.QUARANTINED


def _step(attempt: Column, status, note=None, error=None, backoff=None) -> Column:
    parts = [attempt, F.lit(status), F.lit(note) if not isinstance(note, Column) else note,
             F.lit(error) if not isinstance(error, Column) else error,
             F.lit(backoff) if not isinstance(backoff, Column) else backoff]
    return F.struct(*[p.cast(f.dataType).alias(f.name) for p, f in zip(parts, AUDIT_STEP.fields)])


def with_audit_trail(resolved):
    """Adds `audit_trail`: one step per failed attempt, then how it ended."""
    retry_steps = F.transform(
        F.sequence(F.lit(1), F.col("retries")),
        lambda n: _step(n, V.STEP_RETRY, error=V.REASON_TRANSIENT,
                        backoff=F.round(n * F.lit(V.BACKOFF_STEP_S), 2)),
    )
    nothing = F.array().cast(T.ArrayType(AUDIT_STEP))
    ending = (
        F.when(is_accepted(), _step(F.col("attempts"), V.STEP_SUCCESS,
                                    note=F.format_string(V.NOTE_SUCCESS, F.col("attempts").cast("string"))))
        .when(F.col("_permanent"), _step(F.lit(1), V.STEP_FATAL, error=F.col("error_reason")))
        .otherwise(_step(F.col("attempts"), V.STEP_EXHAUSTED, error=F.col("error_reason")))
    )
    trail = F.concat(F.when(F.col("retries") > 0, retry_steps).otherwise(nothing), F.array(ending))
    return resolved.withColumn("audit_trail", trail)


def audit_steps(resolved):
    """The audit trail as rows.

    No trail is empty, so the outer form gives the same rows; the inner one would compute
    every trail twice, to filter out empty ones.
    """
    steps = with_audit_trail(resolved).select("seq", "orderId", F.explode_outer("audit_trail").alias("step"))
    return steps.select("seq", "orderId", "step.*")


def accepted(resolved):
    return resolved.where(is_accepted())


def rejected(resolved):
    return resolved.where(~is_accepted())


def total_type(price_type):
    """What totals of a price are kept in: see `average` for the 24 digits before the point."""
    if isinstance(price_type, T.DecimalType):
        return T.DecimalType(min(38, 24 + price_type.scale), price_type.scale)
    return price_type


def with_running_average(resolved, prior_orders=0, prior_total=0, prior_rejects=0, **running_options):
    """Adds `total_orders`, `total_rejects` and `running_avg` as they stand at each order.

    A rejected order shows the average of those accepted before it and does not move it.
    `prior_*` carry what earlier batches came to.
    """
    value_type = resolved.schema["price_value"].dataType
    measures = {
        "total_orders": F.when(is_accepted(), 1).otherwise(0).cast("long"),
        "total_rejects": F.when(is_accepted(), 0).otherwise(1).cast("long"),
        "cumulative_price": F.when(is_accepted(), F.col("price_value")).otherwise(F.lit(0).cast(value_type)),
    }
    totals = running_totals(resolved, "seq", measures, **running_options)
    return totals.withColumns({
        "total_orders": F.col("total_orders") + F.lit(prior_orders),
        "total_rejects": F.col("total_rejects") + F.lit(prior_rejects),
        "cumulative_price": (F.col("cumulative_price") + F.lit(prior_total)).cast(total_type(value_type)),
    }).withColumn("running_avg", average(F.col("cumulative_price"), F.col("total_orders")))


def with_fallback_names(outcomes):
    """Outcomes show a placeholder where the message lacks its id, product or price."""
    return outcomes.withColumns({
        "orderId": F.coalesce("orderId", F.lit(V.UNKNOWN_ORDER)),
        "product": F.coalesce("product", F.lit(V.UNKNOWN_PRODUCT)),
        "price": F.coalesce("price", F.lit(0).cast(outcomes.schema["price"].dataType)),
    })


def process_orders(orders, max_retries=V.MAX_RETRIES, price_type=PRICE_TYPE, **running_options):
    """Every order with its outcome, audit trail and running average.

    The trail is made last, so that it is not shuffled and sorted with the totals.
    """
    outcomes = with_audit_trail(with_running_average(resolve(orders, max_retries, price_type), **running_options))
    return with_fallback_names(outcomes.drop("_permanent"))


def average_price(resolved):
    """Average price of the accepted orders, 0.0 if there are none."""
    total = F.sum(F.when(is_accepted(), F.col("price_value"))).cast(total_type(resolved.schema["price_value"].dataType))
    return resolved.agg(average(total, F.count_if(is_accepted())).alias("avg_price"))


def order_kpis(resolved):
    return resolved.agg(
        F.count_if(is_accepted()).alias("total_orders"),
        F.count_if(is_accepted()).alias("success_count"),
        F.coalesce(F.sum(F.col("retries").cast("long")), F.lit(0)).alias("retries_count"),
        F.count_if(~is_accepted()).alias("dlq_count"),
    )


def newest(outcomes, count, order="seq"):
    """The `count` newest rows, newest first; a top-k per task, never a full sort."""
    return outcomes.orderBy(F.col(order).desc()).limit(count)


def newest_oldest_first(outcomes, count, order="seq"):
    return newest(outcomes, count, order).orderBy(order)
