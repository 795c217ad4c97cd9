"""Registered queries on the bench tables and the equivalent SQL to check them with."""
