"""Column expressions (JVM-side, codegen'd) and the few Arrow UDFs."""
