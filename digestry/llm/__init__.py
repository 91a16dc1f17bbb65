"""Operators for large training corpora: scans, deduplication, decontamination, scoring, mixing and output."""
