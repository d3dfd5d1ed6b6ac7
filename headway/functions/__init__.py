"""Column helpers. Each takes and returns columns, so all work stays in code generation."""
