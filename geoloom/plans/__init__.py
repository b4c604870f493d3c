"""Registered queries, their inputs, and whole workflows."""
