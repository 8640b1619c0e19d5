from meterline.functions import months, outcomes, paths

__all__ = ["months", "outcomes", "paths"]
