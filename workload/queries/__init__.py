"""Queries by area. Importing this package registers all of them."""

from workload.queries import catalogs, daily, errors, export, listing, progress, projects, selection  # noqa: F401
