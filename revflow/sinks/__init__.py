"""Writers. Each writes from all tasks at once; none gathers rows first."""
