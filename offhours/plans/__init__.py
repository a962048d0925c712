"""Named pipelines composed of the operators: what a user calls."""
