"""Landed payloads in, item rows out."""
