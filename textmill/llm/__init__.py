"""Operators for preparing training data: filters, deduplication, decontamination, mixing."""
