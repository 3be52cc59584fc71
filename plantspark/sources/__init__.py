"""Where rows come from and go to: messages, measurement tables, benchmark views."""
