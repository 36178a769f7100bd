from tidemark.streaming.replace import replace_batch, start_replace_stream

__all__ = ["replace_batch", "start_replace_stream"]
