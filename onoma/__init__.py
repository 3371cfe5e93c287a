"""A PySpark engine for name-authority data."""
