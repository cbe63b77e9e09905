"""Readers for the raw tables and writers for the results."""
