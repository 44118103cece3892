"""Layer loads, reporting views, quality checks and the whole pipeline."""
