"""Readers, file listing and file-kind detection."""
