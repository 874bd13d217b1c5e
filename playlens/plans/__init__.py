"""Reports, star-schema analytics, gold aggregates and the layer pipeline."""
