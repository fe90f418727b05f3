"""Readers and writers of entity tables, ground truth, pairs and submissions."""
