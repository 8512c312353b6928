"""Composed jobs: control tables, source runs, replays and the query catalogue."""
