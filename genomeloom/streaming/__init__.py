"""Structured Streaming twins of the record and run-state jobs.

Sources land as JSON lines in a folder. State lives in the state store under the
query's checkpoint, so a lost executor costs a replay of the last micro-batch.
"""
