"""Business rules, in one immutable object that every operator takes."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

INDIVIDUALS = "INDIVIDUALS"
SELLERS = "SELLERS"
UNKNOWN = "UNKNOWN"


@dataclass(frozen=True)
class HabitRule:
    """When a user of a segment has formed the habit inside the window."""

    min_transactions: int
    min_days: int | None = None
    collections_only: bool = False


def _default_habit() -> dict[str, HabitRule]:
    every_family = HabitRule(min_transactions=5, min_days=5)
    return {
        INDIVIDUALS: every_family,
        SELLERS: HabitRule(min_transactions=5, collections_only=True),
        UNKNOWN: every_family,
    }


@dataclass(frozen=True)
class Rules:
    """Fixed values of the business."""

    payment_types: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 7)
    collection_types: tuple[int, ...] = (8, 9)
    segment_codes: tuple[int, ...] = (1, 2)
    id_prefix: str = "MLB"
    # Inclusive bounds. On timestamps the upper one is midnight, so later hours
    # of that day are out; on dates the whole day is in.
    date_from: str = "2022-01-01"
    date_to: str = "2022-12-31"
    onboarding_days: int = 30
    habit: dict[str, HabitRule] = field(default_factory=_default_habit)
    control_percent: int = 5
    max_missing_percent: float = 10.0

    def __post_init__(self) -> None:
        both = set(self.payment_types) & set(self.collection_types)
        if both:
            raise ValueError(f"types in both families: {sorted(both)}")
        missing = {INDIVIDUALS, SELLERS, UNKNOWN} - set(self.habit)
        if missing:
            raise ValueError(f"no habit rule for {sorted(missing)}")
        if datetime.fromisoformat(self.date_from) > datetime.fromisoformat(self.date_to):
            raise ValueError(f"no dates from {self.date_from} to {self.date_to}")
        if self.onboarding_days < 0:
            raise ValueError("onboarding_days must not be negative")
        if not 0 <= self.control_percent <= 100:
            raise ValueError("control_percent must be in 0..100")

    @property
    def valid_types(self) -> tuple[int, ...]:
        return self.payment_types + self.collection_types

    @property
    def id_pattern(self) -> str:
        return f"^{self.id_prefix}[0-9]+$"

    @property
    def id_digits(self) -> str:
        return f"^{self.id_prefix}([0-9]+)$"

