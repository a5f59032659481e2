"""Stateless request scoring that runs on batch or streaming DataFrames."""
