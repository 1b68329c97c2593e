"""Matching of arriving rows."""
