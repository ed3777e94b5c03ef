"""Column expressions; every one stays inside JVM code generation."""
