"""Tests of the training-data operators; a package, so that its conftest does not hide the other."""
