"""Readers and writers: raw records, reference files, stored tables, bench data."""
