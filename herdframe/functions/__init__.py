"""Column functions: native expressions only, so they stay inside code generation."""
