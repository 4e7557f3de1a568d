"""Readers, writers and the mapping of the event table to packets."""
