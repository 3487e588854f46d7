"""The fifteen-minute metrics as streams."""
