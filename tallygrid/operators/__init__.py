"""DataFrame to DataFrame steps of a survey analysis, for all species at once."""
