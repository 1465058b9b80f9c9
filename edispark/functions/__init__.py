"""Subpackage of edispark."""
