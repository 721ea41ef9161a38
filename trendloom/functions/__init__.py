"""Column expressions shared by the operators; all run on the JVM side."""
