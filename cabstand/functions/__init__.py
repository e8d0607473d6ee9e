"""Column -> Column helpers; all built-in expressions, so whole-stage codegen stays intact."""
