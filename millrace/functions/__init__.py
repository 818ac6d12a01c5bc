"""Column expressions shared by the plans; all of them run inside the JVM."""
