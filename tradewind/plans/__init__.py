"""Metric plans: each a lazy function of a Star (or of the clean tables) and thresholds."""
