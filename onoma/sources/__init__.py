"""Readers of authority sources, as DataFrames with explicit schemas."""
