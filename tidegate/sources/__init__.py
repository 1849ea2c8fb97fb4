from tidegate.sources.files import preview, read_file
from tidegate.sources.jdbc import read_table
from tidegate.sources.topics import read_binary_topic, read_text_topic

__all__ = ["preview", "read_binary_topic", "read_file", "read_table", "read_text_topic"]
