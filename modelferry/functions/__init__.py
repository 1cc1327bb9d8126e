"""Column expressions; every one is built in, none leaves the JVM."""
