"""Column expressions; built-ins only, so they stay in whole-stage codegen."""
