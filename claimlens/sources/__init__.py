"""Table readers and writers, policy tables, and the claim adapter."""
