"""Where events, manifests and bookmarks go."""
