"""Readers, the dataset catalogue and the by-day cube store."""
