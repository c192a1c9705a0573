"""Readers: CSV scans, file streams, landed tables."""
