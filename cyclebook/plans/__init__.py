"""Normalizers, the dataset build, and the reports on the enriched trade table."""
