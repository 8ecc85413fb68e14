"""Part of the cairn engine."""
