"""Building blocks between the raw text layer and the metric plans."""
