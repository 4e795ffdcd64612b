"""Scalar building blocks (``scalar``)."""
