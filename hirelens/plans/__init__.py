"""Silver, Gold, warehouse queries, dashboards, the salary model and the estimator."""
