"""Readers, writers, generators and the star-schema mapping."""
