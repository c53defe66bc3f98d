"""Analytical operators: each takes a Model (and parameters) and returns a lazy DataFrame."""
