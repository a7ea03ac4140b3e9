"""End-to-end plans: load tables, select features, build a model, score."""
