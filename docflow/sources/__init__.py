"""Where rows come from: the paged literature service, corpus folders, configuration."""
