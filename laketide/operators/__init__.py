"""DataFrame-to-DataFrame operators: privacy, model, report, workspace, mining."""
