"""Readers, writers and the data-model views."""
