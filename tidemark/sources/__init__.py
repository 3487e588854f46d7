"""Readers, writers, table profile and the test views."""
