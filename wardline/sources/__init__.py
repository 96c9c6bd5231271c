"""Readers and writers: landing files, boundaries, partitioned tables, test derivations."""
