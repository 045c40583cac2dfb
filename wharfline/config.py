"""Thresholds of the quality checks."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class QualityConfig:
    """Fractions (0-1) above which a check fails; the comparison is strict."""

    null_threshold: float = 0.05
    duplicate_threshold: float = 0.01
