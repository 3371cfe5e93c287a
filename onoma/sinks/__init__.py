"""Packs, reports and bundles."""
