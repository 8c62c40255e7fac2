"""Where rows come from: streams, contract texts, tables and their history."""
