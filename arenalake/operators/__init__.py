"""Reusable DataFrame operators: selection, manifests, envelopes, backfill, quality, contracts."""
