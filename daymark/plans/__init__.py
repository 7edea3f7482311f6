"""Jobs and KPI queries composed from the operators."""
