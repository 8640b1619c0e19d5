from meterline.streaming import events, ingest

__all__ = ["events", "ingest"]
