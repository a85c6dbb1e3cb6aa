"""Parameters handed to operators; nothing is read from module or session globals."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from acctrisk import fixed


def _current_weights() -> dict[str, float]:
    names = [weight for _, weight, _, _ in fixed.SIGNALS]
    return dict(zip(names, fixed.WEIGHT_CONFIGS[fixed.CURRENT_CONFIG]))


@dataclass(frozen=True)
class ScoringParams:
    """Everything a scoring run may vary."""

    snapshot_date: date = date(2026, 4, 10)
    window_days: int = 90
    recent_days: int = 90
    high_threshold: float = 0.60
    medium_threshold: float = 0.35
    weights: Mapping[str, float] = field(default_factory=_current_weights)

    @classmethod
    def from_mapping(cls, settings: Mapping[str, str]) -> ScoringParams:
        """Read overrides from text settings such as an environment mapping."""
        base = cls()
        # Setting names and the weight each one overrides
        weight_settings = {
            "WEIGHT_USAGE_DECLINE": "usage",
            "WEIGHT_SUPPORT_HEALTH": "tickets",
            "WEIGHT_NPS": "nps",
            "WEIGHT_CSM_SENTIMENT": "csm",
            "WEIGHT_SDK_RISK": "sdk",
            "WEIGHT_ENGAGEMENT": "engagement",
        }
        weights = dict(base.weights)
        for setting, weight in weight_settings.items():
            if setting in settings:
                weights[weight] = float(settings[setting])
        snapshot = settings.get("DATASET_DATE")
        return cls(
            snapshot_date=date.fromisoformat(snapshot) if snapshot else base.snapshot_date,
            window_days=int(settings.get("RENEWAL_WINDOW_DAYS", base.window_days)),
            weights=weights,
        )


DEFAULT = ScoringParams()
