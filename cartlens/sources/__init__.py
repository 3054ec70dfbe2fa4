"""Readers, sinks and the adapter from the provided tables to basket tables."""
