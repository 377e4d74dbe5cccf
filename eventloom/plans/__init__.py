"""Modelled tables, batch jobs and the registry of checked queries."""
