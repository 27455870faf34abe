"""Transforms that work the same on batch and streaming DataFrames."""
