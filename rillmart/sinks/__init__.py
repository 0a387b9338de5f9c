"""Writers for micro-batches. Replaying a batch replaces what it wrote before."""
