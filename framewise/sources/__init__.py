from framewise.sources.codec import (
    decode,
    encode_counts,
    encode_emotion_event,
    encode_wave_event,
    frame_messages,
    list_messages,
    read_emotion_events,
    source_key,
    split_messages,
    with_source,
)
from framewise.sources.topics import FileTopics, KafkaTopics, tail_lines, write_console

__all__ = [
    "FileTopics",
    "KafkaTopics",
    "decode",
    "encode_counts",
    "encode_emotion_event",
    "encode_wave_event",
    "frame_messages",
    "list_messages",
    "read_emotion_events",
    "source_key",
    "split_messages",
    "tail_lines",
    "with_source",
    "write_console",
]
