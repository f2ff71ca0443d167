"""Reports and checks as SQL text; tables and limits are named parameters."""
