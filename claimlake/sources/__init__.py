"""Scans: Bronze CSV feeds, Silver history by load_date, Gold snapshots, fixtures."""
