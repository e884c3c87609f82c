"""Kafka topics. Needs Spark's Kafka connector on the class path."""

from pyspark.sql import functions as F

from feedstream.operators.parse import decode
from feedstream.reference_data import LINGER_MS


def source_options(
    servers, topic, starting="latest", max_per_trigger=None, min_partitions=None, **extra
):
    """Options of the reader.

    ``starting`` counts for the first start only, later ones resume from the checkpoint.
    ``min_partitions`` lets several tasks share one large topic partition.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": max_per_trigger,
        "minPartitions": min_partitions,
        **extra,
    }
    return {k: str(v) for k, v in options.items() if v is not None}


def sink_options(servers, topic, linger_ms=None, **extra):
    options = {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.linger.ms": linger_ms,
        **extra,
    }
    return {k: str(v) for k, v in options.items() if v is not None}


def publish_options(servers, topic):
    """Sink options of the ingest side, which gathers messages before it sends them."""
    return sink_options(servers, topic, linger_ms=LINGER_MS)


def read_topic(spark, servers, topic, streaming=True, starting=None, keep=(), **options):
    """The topic's messages as JSON text. A table reads the topic from its start.

    ``keep`` names columns of the source to carry along, such as partition and offset.
    """
    start = starting or ("latest" if streaming else "earliest")
    reader = spark.readStream if streaming else spark.read
    chosen = source_options(servers, topic, start, **options)
    return decode(reader.format("kafka").options(**chosen).load(), keep=keep)


def message_place():
    """What orders the messages of a topic: their time, then partition and offset."""
    return F.struct("timestamp", "partition", "offset")
