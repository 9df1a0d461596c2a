"""DataFrame operators: features, training views, rollups, distributed order statistics, models."""
