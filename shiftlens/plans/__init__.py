"""The layers: cleaning, star schema, KPIs, lookups, quality reports and the full run."""
