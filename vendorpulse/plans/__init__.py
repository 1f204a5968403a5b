"""Composed plans: multi-date feature table, reference-shaped comparison plan, job modes."""
