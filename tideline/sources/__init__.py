"""Where frames come from: object listings, manifests, replicas, metadata."""
