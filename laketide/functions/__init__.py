"""Column-level building blocks (expressions, rules, size checks)."""
