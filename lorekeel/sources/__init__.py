"""Readers of raw records into unified documents."""
