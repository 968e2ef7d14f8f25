"""Operators on whole tables: audit, features, models, language scan."""
