"""Scoring of unbounded comment streams."""
