"""Reading raw inputs and writing tables, audit rows and watermarks."""
