"""Image quality rules: statuses, usability and verdicts as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Image keys in publishing order, statuses and verdicts.
IMAGES = ("s2_pre", "s2_post", "s1_pre", "s1_post")
UNUSABLE = ("missing", "empty", "unreadable", "corrupt", "blank_white", "partial_severe")
COMPROMISED = ("partial_moderate",)
HARD_DEFECTS = ("partial_severe", "blank_white", "missing", "corrupt", "empty")
SOFT_DEFECTS = ("cloudy", "partial_moderate", "speckled", "partial_minor")
FLAGS = ("is_partial", "is_white", "is_corrupt", "is_empty", "is_speckle", "is_cloudy")


@dataclass(frozen=True)
class QualitySpec:
    """Thresholds of the image scan (fixed values; sizes are parameters so small tiles can be tested)."""

    height: int = 512
    width: int = 512
    optical_bands: int = 12
    radar_bands: int = 2
    core_bands: int = 11
    blue: int = 0
    green: int = 1
    red: int = 2
    swir: int = 9
    empty_share: float = 0.98
    optical_partial: float = 0.005
    radar_partial: float = 0.02
    blob_share: float = 0.95
    moderate: float = 0.05
    severe: float = 0.15
    white_floor: float = 2000.0
    flatness: float = 0.25
    white_swir: float = 800.0
    white_share: float = 0.80
    cloud_share: float = 0.35
    saturated: float = 10000.0
    veto_clear: float = 0.90
    constant_std: float = 1.0
    min_valid_px: int = 10000
    dropout: float = 1e-4


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def partial_severity(share, spec: QualitySpec = QualitySpec()) -> Column:
    share = _col(share)
    return (
        F.when(share < spec.moderate, "partial_minor")
        .when(share < spec.severe, "partial_moderate").otherwise("partial_severe")
    )


def usability(status) -> Column:
    status = _col(status)
    return (
        F.when(status.isin(*UNUSABLE), "unusable")
        .when(status.isin(*COMPROMISED), "compromised").otherwise("usable")
    )


def chip_verdict(statuses: list[Column], s2_usable, s1_usable, any_partial, any_cloudy) -> Column:
    """Worst defect first."""
    dead = [s.isin("missing", "empty") for s in statuses]
    slight = [s.isin("speckled", "partial_minor") for s in statuses]
    s2_bad, s1_bad = ~_col(s2_usable), ~_col(s1_usable)
    return (
        F.when(dead[0] & dead[1] & dead[2] & dead[3], "dead")
        .when(s2_bad & s1_bad, "both_unusable")
        .when(s2_bad, "s2_unusable")
        .when(s1_bad, "s1_unusable")
        .when(_col(any_partial), "partial_edge")
        .when(_col(any_cloudy), "cloudy")
        .when(slight[0] | slight[1] | slight[2] | slight[3], "minor")
        .otherwise("clean")
    )
