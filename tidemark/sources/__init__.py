"""Readers and writers: manifests, policies, journals, inventories, frames, reports."""
