"""Left lookup of a one-row-per-key dimension, safe for large dimensions and hot keys."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
STREAM_SALTS = 8


def measured_bytes(df):
    """The size of the rows themselves, by one aggregate over them."""
    width = F.lit(16)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16
        else:
            width = width + 16
    return df.agg(F.sum(width.cast("long")).alias("bytes")).first()["bytes"] or 0


def lookup(facts, dim, key, max_broadcast_bytes=BROADCAST_BYTES, salts=STREAM_SALTS, dim_bytes=None):
    """`facts` left-joined to `dim`, which holds at most one row per `key`.

    * A dimension measured below the limit is broadcast: no shuffle of the facts.
    * A larger one is sort-merge joined, the facts read once. Adaptive execution splits the
      partitions of hot keys, and of rows without a key, over several tasks.
    * On a stream nothing is adaptive, so the key is salted instead. That copies the
      dimension `salts` times per micro-batch; for a very large one enrich inside
      `foreachBatch`, where each batch is a table.

    `dim_bytes`, if the size is known, saves measuring it again.
    """
    size = measured_bytes(dim) if dim_bytes is None else dim_bytes
    if size <= max_broadcast_bytes:
        return facts.join(F.broadcast(dim), key, "left")
    if facts.isStreaming:
        return _salted(facts, dim, key, salts)
    return facts.join(dim.hint("merge"), key, "left")


def _salted(facts, dim, key, salts):
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(salts)).cast("int")
    spread = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # Spark's estimate of `spread` knows neither the copies nor what packed files unfold to, and would have it broadcast.
    return facts.withColumn("_salt", salt).join(spread.hint("merge"), [key, "_salt"], "left").drop("_salt")
