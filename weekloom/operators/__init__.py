"""Panel operators. Each takes a DataFrame and keyword parameters and returns a lazy DataFrame.

A *panel* has one row per (entity, week), so a window over one entity never holds more rows
than there are weeks. Inputs without that bound (raw observations, snapshot indexes, events)
are reduced with map-side combining aggregates or cut into time buckets first.
"""
