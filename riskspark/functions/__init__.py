"""Column expressions. Everything here stays inside whole-stage codegen."""
