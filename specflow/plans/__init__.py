"""Describe pipelines, load them from their JSON files, and run them."""
