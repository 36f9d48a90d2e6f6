"""Records to a Kafka topic. Needs Spark's Kafka connector on the cluster."""

from ..fixed_values import TRIGGER_INTERVAL
from ..operators.decode import encode_keyed_json
from ..streaming.zones import trigger_of


def publish_rows(rows, servers, topic, key="household_id"):
    """A table as keyed JSON records, in parallel, each key into one topic partition."""
    encode_keyed_json(rows, key).write.format("kafka").options(**_target(servers, topic)).save()


def start_publishing(rows, servers, topic, checkpoint, key="household_id", trigger=TRIGGER_INTERVAL):
    """A stream as keyed JSON records."""
    return (
        encode_keyed_json(rows, key).writeStream.format("kafka").options(**_target(servers, topic))
        .option("checkpointLocation", checkpoint).trigger(**trigger_of(trigger)).start()
    )


def _target(servers, topic):
    return {"kafka.bootstrap.servers": servers, "topic": topic}
