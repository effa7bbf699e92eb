"""Importing this module registers every query."""

from checks import q_extension, q_io, q_joins, q_pages, q_plans, q_reports, q_scalars, q_streams, q_windows  # noqa: F401
