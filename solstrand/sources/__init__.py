"""Readers: batch tables, message streams, landed API pages, listings."""
