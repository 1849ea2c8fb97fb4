from tidegate.sinks.files import write_file
from tidegate.sinks.jdbc import write_table
from tidegate.sinks.topics import write_topic, write_topic_stream
from tidegate.sinks.versions import publish_file, published_versions, read_published

__all__ = [
    "publish_file",
    "published_versions",
    "read_published",
    "write_file",
    "write_table",
    "write_topic",
    "write_topic_stream",
]
