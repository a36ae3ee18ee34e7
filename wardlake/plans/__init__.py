"""Reporting views, analytical queries, KPI measures and the nightly run."""
