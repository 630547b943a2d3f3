"""DataFrame -> DataFrame operators on tick series."""
