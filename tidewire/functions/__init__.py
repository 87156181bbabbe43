"""Column expressions: text, lexicons, polarity. All run inside the JVM."""
