"""innflow: cleaning, quarantine, checks and marts for multi-source booking data, on Spark."""
