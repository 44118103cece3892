"""The incremental Silver load driven by newly landed files."""
