"""Whole plans: the dataset build and the registered queries."""
