from meterline.operators import checks, conform, drift, marts, rules, runs

__all__ = ["checks", "conform", "drift", "marts", "rules", "runs"]
