from kempt.streaming.ingest import dedupe_stream, ingest_stream, stream_steps

__all__ = ["dedupe_stream", "ingest_stream", "stream_steps"]
