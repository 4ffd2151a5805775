"""Two-zone document collections as Spark DataFrame operators."""
