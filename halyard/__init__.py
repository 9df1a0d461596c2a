"""Subscriber analytics as Spark jobs: features, training views, models, segments and metrics."""
