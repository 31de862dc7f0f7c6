"""Scalar, array and tree functions over Columns."""
