"""Reading and writing graphs, snapshots and file listings."""
