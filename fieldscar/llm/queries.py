"""Imports every operator module, which registers its query."""

from . import (  # noqa: F401
    decontamination, html_blocks, jaccard, licenses, mixing, negatives, neighbours, packing, periods, pii, toxicity, warc, winnowing)
from .common import ORACLES, QUERIES  # noqa: F401
