from karst.streaming.append import append_stream

__all__ = ["append_stream"]
