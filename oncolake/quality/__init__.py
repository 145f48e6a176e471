"""Quality views over resources, a library of expectations and the suites that use it."""
