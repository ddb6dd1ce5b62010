from lastro.streaming.arrivals import ingest_arrivals

__all__ = ["ingest_arrivals"]
