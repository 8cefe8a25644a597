"""Column expressions: safe casts, keys, snapshots and scores. All run inside the JVM."""
