"""Column expressions shared by the operators. All of them are built-in Spark
functions, so they stay on the JVM and need no Python worker."""
