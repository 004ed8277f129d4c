"""Landed pages and stored datasets: scans, write disciplines, control tables."""
