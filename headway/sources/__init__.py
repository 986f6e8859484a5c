"""Landed files: timetables, realtime snapshots, manifests."""
