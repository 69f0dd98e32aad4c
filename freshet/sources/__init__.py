"""Where rows and records come from."""
