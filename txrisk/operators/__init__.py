"""DataFrame to DataFrame operators; no reading or writing happens here."""
