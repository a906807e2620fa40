"""DataFrame -> DataFrame operators: features, splits, trainers, scoring, tuning."""
