"""Operators on market tables. All are DataFrame to DataFrame and lazy unless they say otherwise."""
