"""Column helpers; every one is a JVM-side expression."""
