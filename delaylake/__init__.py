"""delaylake: delay analytics for operational event data, written as plain Spark DataFrame code."""
