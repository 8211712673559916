"""Readers and writers: JSON documents, CSV files, archive folders, pages and tables."""
