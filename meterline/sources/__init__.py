from meterline.sources import dims, drifted, footers, landing, tables

__all__ = ["dims", "drifted", "footers", "landing", "tables"]
