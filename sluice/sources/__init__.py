"""Where messages and tables are read from. Every message source has a ``value`` column."""

from .jdbc import read_jdbc
from .messages import (
    bounded_kafka_options,
    kafka_options,
    read_kafka,
    read_messages,
    stream_kafka,
    stream_text,
    strings,
    take_messages,
)

__all__ = [
    "bounded_kafka_options",
    "kafka_options",
    "read_jdbc",
    "read_kafka",
    "read_messages",
    "stream_kafka",
    "stream_text",
    "strings",
    "take_messages",
]
