"""Column functions: text clean-up, parsing, scores and calendar features."""
