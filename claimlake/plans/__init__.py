"""Composed jobs: Bronze->Silver loads, Gold build + publication, IBNR, backfill."""
