"""Readers of raw rows and stored records, and the sinks that write them."""
