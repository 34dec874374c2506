"""Readers of codes, record lines and stored results, and the publishing job."""
