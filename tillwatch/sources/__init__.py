"""Readers, writers, the sample table and views over other schemas."""
