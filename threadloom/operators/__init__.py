"""Operators on posts, comments, batches and graphs."""
