"""Landed documents, generated calendars, request manifests and processed tables."""
