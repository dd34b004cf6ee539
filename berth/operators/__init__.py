"""Operators: DataFrame → DataFrame jobs of the landing zone."""
