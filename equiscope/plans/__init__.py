"""Composed query plans: the public query engine and oracle SQL texts."""
