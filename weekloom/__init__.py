"""weekloom: weekly entity panels on Spark - assemble, repair, grade and report."""

__version__ = "0.1.0"
