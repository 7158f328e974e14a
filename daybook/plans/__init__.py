"""The pipeline's steps, each a function from tables to a table."""
