"""Jobs composed from the operators: landing, staging, star schema, analysis, reads."""
