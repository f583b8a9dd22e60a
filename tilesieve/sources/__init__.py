"""Tables of the workflow: metadata, manifests, tile shards, vectors and reports."""
