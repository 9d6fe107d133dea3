"""Layer builders: cleaning, staging, facts, dimensions, segments, analyses."""
