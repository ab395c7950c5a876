"""Query catalogue."""
