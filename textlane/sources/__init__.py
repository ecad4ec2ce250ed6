"""Readers and writers: JSON, CSV, label maps, snapshots, stop words, run store."""
