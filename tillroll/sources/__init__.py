"""Readers: file listing, CSV headers, sales files, dimensions, JDBC."""
