"""Where rows come from and go to: files, dimensions, month tables, samples."""
