"""Column expressions shared by the operators; all run inside Spark's generated code."""
