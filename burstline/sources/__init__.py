"""Readers and writers: messages, CSV source rows, the stored blacklist, tables."""
