"""Whole jobs: from a change log and a catalog to change tables."""
