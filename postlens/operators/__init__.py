"""DataFrame -> DataFrame operators; all are lazy and take their columns as parameters."""
