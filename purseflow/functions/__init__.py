"""Column functions; all of them stay inside whole-stage code generation."""
