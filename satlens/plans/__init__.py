"""End-to-end plans: model input, scoring, registered queries and their SQL oracles."""
