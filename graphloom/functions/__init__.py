"""Column functions; all but those of ``udfs`` stay inside the JVM."""
