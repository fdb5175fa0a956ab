"""Operators: rules, postal checks and repairs, mapping shaping, skew-safe joins and grouping."""
