"""Fixture tables and queries that run every operator, each with the SQL that checks it."""
