"""Where rows come from: delimited files, the given tables, and lists of file digests."""
