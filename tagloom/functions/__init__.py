"""Column expressions; all run inside the JVM except the model scorer in ``sentiment``."""
