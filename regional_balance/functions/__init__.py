"""Column expressions: every scalar rule of the engine, in the JVM."""
