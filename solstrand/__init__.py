"""Spark jobs for a long-range calendar, a geographic hierarchy, news feeds and an article stream."""
