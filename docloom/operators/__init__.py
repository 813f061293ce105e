"""Filters, sorting, joins, draft views and writes as DataFrame plans."""
