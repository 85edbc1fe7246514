"""Models and marts as pure DataFrame functions."""
