"""Column functions shared by the marts; all of them stay inside the JVM."""
