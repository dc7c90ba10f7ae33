"""Readers and writers of posts, messages and reports."""
