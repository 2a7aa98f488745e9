"""Plans built from the operators: marts, serving queries, run history, monthly jobs."""
