"""Imports every module that registers queries of this package."""

from meterline.llm import contamination, fingerprints, lines, near_duplicates, packing, phrases, quality, repeats, substrings, templates, token_files, warc, whitening  # noqa: F401
from meterline.llm.registry import ORACLES, QUERIES  # noqa: F401
