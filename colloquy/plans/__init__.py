"""Registered queries over the driver tables, each beside its oracle SQL."""
