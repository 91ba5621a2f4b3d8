"""Readers and writers for corpora, logs, catalogs, plans and evidence."""
