"""Onboarding analytics on Spark: cleaning, segments, metrics, funnels, publishing."""

from firstmile.rules import HabitRule, Rules

__all__ = ["HabitRule", "Rules"]
