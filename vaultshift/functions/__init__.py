"""Column-expression helpers (Python-compatible strip, blank tests, CSV cleaning, normalisers)."""
