"""Readers and writers: article JSON, landed feeds, snapshots, reports."""
