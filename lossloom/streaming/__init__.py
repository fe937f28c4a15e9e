"""Intentionally empty.

The workload is a weekly batch that compares two snapshots (`lossloom.operators.sets.snapshot_change`);
there is no streaming operator to offer.
"""
