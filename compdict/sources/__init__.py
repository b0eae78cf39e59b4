"""Reading CIF text and keeping table snapshots."""
