"""DataFrame operators: each is a plain ``DataFrame -> DataFrame`` function."""
