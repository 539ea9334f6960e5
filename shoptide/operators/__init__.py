"""Pure DataFrame operators: frames in, one frame out, no input or output of their own."""
