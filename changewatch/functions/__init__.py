"""Column expressions. All of them stay inside the JVM; there is no Python UDF in the package."""
