"""DataFrame operators: catalog, lookups, changes, snapshots, settings, offsets."""
