"""Column expressions and schema helpers; everything here stays inside the JVM."""
