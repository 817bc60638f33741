"""Column functions: Column in, Column out, JVM expressions only."""
