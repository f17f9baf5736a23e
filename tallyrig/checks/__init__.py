"""Checks of recorded streams as findings, and the run of all phases."""
