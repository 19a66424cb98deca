"""Writers: day partitions, snapshots and text exports."""
