"""Scans: directory tree, study CSV files, site list, SQL."""
