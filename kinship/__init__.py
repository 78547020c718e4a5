"""kinship: batch analytics over a social network (member pages, a follow
graph and an activity log) written as Spark DataFrame plans."""

__version__ = "0.1.0"
