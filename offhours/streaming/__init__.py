"""The incremental jobs as streams over newly landed files."""
