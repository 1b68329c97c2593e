"""Operators over DataFrames: profiles, column pairs, selection, language, row matching, adjudication, quality."""
