"""Column-level building blocks: hash uniforms, text patterns, parameter parsing."""
