"""Parsers of names, files and notices."""
