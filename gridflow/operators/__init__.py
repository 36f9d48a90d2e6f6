"""Transforms from DataFrame to DataFrame."""
