"""Readers: delimited sheets, database extracts, records, markup, text."""
