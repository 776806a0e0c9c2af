"""Readers and writers: text formats in, DataFrames out, and back."""
