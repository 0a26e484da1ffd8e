"""Column functions and calendar windows."""
