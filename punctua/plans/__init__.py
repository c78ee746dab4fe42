"""Whole jobs: from archive files to day tables, from day tables to reports."""
