"""The registered reports."""
