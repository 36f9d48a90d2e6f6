"""Dead letters: numbering, records, and replay after repair."""

from pyspark.sql import functions as F

from ..fixed_values import MAX_RETRIES
from ..functions import padded_key, try_number
from ..session import shared_dir
from .orders import PRICE_TYPE, rejected, resolve, with_audit_trail
from .running import running_totals


MESSAGE = ("orderId", "product", "price", "transient_failures", "permanent_error")


def dead_letters(resolved, at, prior_count=0, **running_options):
    """Dead-letter records of the rejected orders, numbered in arrival order.

    `resolved` may carry `total_rejects` already, as stored outcomes do; then that is the
    number. The trail is made after the numbering.
    """
    failed = rejected(resolved)
    if "total_rejects" in failed.columns:
        numbered = failed.withColumn("_number", F.col("total_rejects"))
    else:
        numbered = running_totals(failed, "seq", {"_number": F.lit(1).cast("long")}, **running_options)
    told = numbered if "audit_trail" in numbered.columns else with_audit_trail(numbered)
    message = F.struct(*MESSAGE)
    return told.select(
        "seq",
        padded_key(F.lit("DLQ-"), F.col("_number") + F.lit(prior_count)).alias("dlq_id"),
        message.alias("failed_message"),
        F.to_json(message).alias("raw"),
        "error_reason",
        "audit_trail",
        F.lit(at).cast("timestamp").alias("timestamp"),
        F.lit(False).alias("replayed"),
    )


def first_requests(requests, order):
    """One request per dead letter, the first asked; a letter is replayed once."""
    return requests.groupBy("dlq_id").agg(F.min_by("corrected_price", F.col(order)).alias("corrected_price"))


def match_requests(letters, requests):
    """Dead letters that were asked for and not yet replayed."""
    return letters.where(~F.col("replayed")).join(requests, "dlq_id")


def missing_requests(letters, requests):
    """Requests for a dead letter that does not exist."""
    return requests.join(letters.select("dlq_id"), "dlq_id", "left_anti")


def repaired_price(price, corrected):
    """The corrected price without its sign, or the message's own without its minus sign."""
    text = F.trim(price)
    return F.when(corrected.isNotNull(), F.abs(corrected).cast("string")) \
        .when(try_number(price) < 0, F.regexp_replace(text, "^-", "")).otherwise(price)


def repair(matched):
    """The matched letters' messages, ready to be processed again."""
    message = F.col("failed_message")
    return matched.select(
        "dlq_id", "seq",
        message["orderId"].alias("orderId"),
        message["product"].alias("product"),
        repaired_price(message["price"], F.col("corrected_price")).alias("price"),
        F.lit(0).alias("transient_failures"),
        F.lit(None).cast("string").alias("permanent_error"),
    )


def replay(letters, requests, last_seq, max_retries=MAX_RETRIES, request_order="request_seq", price_type=PRICE_TYPE):
    """Replays the requested dead letters.

    Returns (outcomes of the replayed messages, the letters with `replayed` updated, the
    requests that matched nothing). Replayed messages arrive right after `last_seq`, in the
    order of their letters; one that fails again is a new dead letter. Letters and requests are matched once, and the matched
    messages checkpointed: numbering and running totals read them several times.
    """
    wanted = first_requests(requests, request_order)
    shared_dir(letters.sparkSession)  # where the checkpoint goes
    messages = repair(match_requests(letters, wanted)).checkpoint()
    counted = running_totals(messages, "seq", {"_place": F.lit(1).cast("long")})
    arrivals = counted.withColumn("seq", F.col("_place") + F.lit(last_seq)).drop("_place")
    asked = wanted.select("dlq_id", F.lit(True).alias("_asked"))
    updated = letters.join(asked, "dlq_id", "left").withColumn(
        "replayed", F.col("replayed") | F.coalesce("_asked", F.lit(False))).drop("_asked")
    return resolve(arrivals, max_retries, price_type), updated, missing_requests(letters, wanted)
