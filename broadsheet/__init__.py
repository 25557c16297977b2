"""Broadsheet: collection, querying and auditing of news archives on Spark."""
