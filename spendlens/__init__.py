"""Project, spend and event analytics as plain ``DataFrame -> DataFrame`` functions."""
