"""Run parameters as plain dataclasses passed to operators."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields, replace
from typing import Any


@dataclass(frozen=True)
class Profile:
    """Candidate selection and funnel thresholds.

    Fixed values: the defaults below are the reference's single preset profile
    (target 50, 30 store pages of 50, 25 chart pages, 4000 candidates,
    200 evaluations, review score >= 9, 80..25000 reviews, no "very positive",
    no player cap, player lookup on, 5 sample reviews).
    """

    target: int = 50
    store_pages: int = 30
    store_page_size: int = 50
    store_language: str = "english"
    chart_pages: int = 25
    max_candidates: int = 4000
    max_evaluations: int | None = 200  # None: no limit; 0 evaluates nothing
    min_review_score: int = 9
    min_total_reviews: int = 80
    max_total_reviews: int = 25000
    allow_very_positive: bool = False
    max_current_players: int | None = None
    skip_current_players: bool = False
    sample_reviews: int = 5

    def with_overrides(self, **overrides: Any) -> "Profile":
        """Apply overrides; an unknown key is an error, as in the reference."""
        known = {f.name for f in fields(self)}
        unknown = sorted(set(overrides) - known)
        if unknown:
            raise ValueError("unknown profile keys: " + ", ".join(unknown))
        return replace(self, **overrides)

    def as_dict(self) -> dict[str, Any]:
        return asdict(self)


@dataclass(frozen=True)
class ScoreParams:
    """Hidden-gem score weights, price cap and tier cut-offs.

    Fixed values: weights 0.50 quality / 0.30 obscurity / 0.20 price, price cap
    60.0, tier S at >= 0.85, tier A at >= 0.70, else B, score rounded to 4 digits.
    """

    w_quality: float = 0.50
    w_obscurity: float = 0.30
    w_price: float = 0.20
    price_cap: float = 60.0
    tier_s: float = 0.85
    tier_a: float = 0.70
    digits: int = 4

    def with_overrides(self, **overrides: Any) -> "ScoreParams":
        return replace(self, **overrides)
