"""No streaming operators: every run is a bounded batch."""
