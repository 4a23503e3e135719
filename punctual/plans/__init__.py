"""Jobs and questions: enrichment, delay and weather analyses, lookups, features, models."""
