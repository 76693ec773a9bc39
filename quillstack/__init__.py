"""Quillstack: document-archive analytics as Spark DataFrame programs."""
