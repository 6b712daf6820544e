"""Multi-step dataflows and the query catalogue."""
