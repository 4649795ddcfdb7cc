"""Run settings. Nothing in the package reads the wall clock: "now" is always ``as_of``."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta


@dataclass(frozen=True)
class Settings:
    as_of: datetime

    # Thresholds and sizes that results depend on.
    window_days: int = 28
    item_bin_size: int = 1_000_000
    max_item_number: int | None = 150_000_000
    min_score_unregistered: float = 0.9
    min_edits_unregistered: int = 10
    min_score_registered: float = 0.7
    min_edits_registered: int = 10
    min_item_usage: float = 500.0
    histogram_bins: int = 101
    block_age_days: int = 365
    head_rows: int = 50
    head_rows_patrollers: int = 20
    min_category_total: int = 10
    min_language_total: int = 300
    min_property_total: int = 500
    min_sitelink_total: int = 300
    top_languages: int = 10

    @property
    def today(self) -> datetime:
        return self.as_of.replace(hour=0, minute=0, second=0, microsecond=0)

    @property
    def window_start(self) -> datetime:
        return self.today - timedelta(days=self.window_days)

    def days_ago(self, days: int) -> datetime:
        return self.as_of - timedelta(days=days)
