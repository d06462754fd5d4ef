"""Column functions: text in, column out. None of them shuffles or leaves the JVM."""
