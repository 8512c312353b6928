"""DataFrame -> DataFrame operators; no side effects."""
