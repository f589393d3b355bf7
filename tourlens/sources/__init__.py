"""Where rows come from: the table registry, the table store and landed documents."""
