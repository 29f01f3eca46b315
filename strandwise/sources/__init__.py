"""Readers and writers of sequence, call, taxonomy and sheet files."""
