"""Tables and result sets, each a function from frames to a frame."""
