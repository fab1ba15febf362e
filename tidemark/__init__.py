"""Daily-bar equity research as Spark DataFrame transforms."""
