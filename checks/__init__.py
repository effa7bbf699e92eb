"""Registered queries with their SQL counterparts, and the inputs they derive from the tables."""
