"""Column expressions; all run inside the JVM except the SHA3 digest."""
