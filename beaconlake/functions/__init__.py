"""Column-level building blocks shared by operators and reports."""
