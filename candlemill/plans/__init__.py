"""Whole stages: what to run to get from one layer to the next."""
