"""Streams of filings and payment lines."""
