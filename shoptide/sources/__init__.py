"""Readers and writers for the tables and views."""
