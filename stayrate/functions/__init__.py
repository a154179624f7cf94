"""Column-in, column-out helpers. Everything here stays on the JVM."""
