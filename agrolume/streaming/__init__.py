"""Micro-batch loading of files into the stored tables."""

from agrolume.streaming.loads import file_stream, stream_chunks, stream_prices, stream_upsert, stream_zarc, stream_zarc_files

__all__ = ["file_stream", "stream_chunks", "stream_prices", "stream_upsert", "stream_zarc", "stream_zarc_files"]
