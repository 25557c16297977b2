"""Column functions: text, dates and markup, all evaluated inside the JVM."""
