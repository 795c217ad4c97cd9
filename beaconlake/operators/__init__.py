"""Composable DataFrame operators: ingestion, reference rules, checks, maintenance."""
