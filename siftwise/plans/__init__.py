"""Plan-level helpers: sessions, stage tables, size-checked broadcasts."""
