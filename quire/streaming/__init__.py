from quire.streaming.ingest import ingest_csv_stream

__all__ = ["ingest_csv_stream"]
