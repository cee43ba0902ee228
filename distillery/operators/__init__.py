"""DataFrame -> DataFrame operators. All are lazy; none collects to the driver."""
