"""Run parameters: preset values and override checking."""

from __future__ import annotations

import pytest

from sleeper.config import Profile, ScoreParams


def test_profile_preset_and_overrides():
    p = Profile()
    assert (p.target, p.max_candidates, p.max_evaluations, p.min_review_score) == (50, 4000, 200, 9)
    assert (p.min_total_reviews, p.max_total_reviews, p.allow_very_positive, p.max_current_players) == (
        80, 25000, False, None)
    q = p.with_overrides(target=5, allow_very_positive=True)
    assert (q.target, q.allow_very_positive, q.max_evaluations) == (5, True, 200)
    with pytest.raises(ValueError, match="unknown profile keys: bogus"):
        p.with_overrides(bogus=1)


def test_score_params_defaults():
    s = ScoreParams()
    assert (s.w_quality, s.w_obscurity, s.w_price, s.price_cap, s.tier_s, s.tier_a, s.digits) == (
        0.50, 0.30, 0.20, 60.0, 0.85, 0.70, 4)
