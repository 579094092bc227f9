"""Where rows come from and go to: item batches, tables with published versions, the catalog."""
