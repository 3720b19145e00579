"""Running order totals."""
