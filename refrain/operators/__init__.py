"""Builders from DataFrame to DataFrame: cleaning, metrics, segments, text, statistics, models."""
