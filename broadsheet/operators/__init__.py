"""DataFrame operators over items, snapshots, records and bodies."""
