"""Column expressions: no session, no jobs, everything stays in generated JVM code."""
