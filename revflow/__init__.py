"""revflow: revenue-cycle report operators and marts as PySpark plans."""
