"""Operators put together to complete jobs."""
