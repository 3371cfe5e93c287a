"""Resumable scans and paged harvests."""
