"""Column expressions shared by the operators. Everything stays on the JVM side."""
