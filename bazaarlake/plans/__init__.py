"""The shop model: staging, intermediate, marts, checks, dashboards, daily run."""
