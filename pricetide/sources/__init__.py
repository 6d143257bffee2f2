"""Reading raw captures and writing results."""
