"""Column expressions and small column-list rules; no actions run here."""
