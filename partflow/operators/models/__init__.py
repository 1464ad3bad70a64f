"""Forecast models. Each turns feature rows into a ``predicted`` column."""
