"""Readers: landing files, test-table projections, audit events."""
