"""DataFrame operators: harmonise, gate, measure, profile, publish, govern and triage."""
