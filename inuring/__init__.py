"""Retro cession and event-loss analytics as Spark jobs."""
