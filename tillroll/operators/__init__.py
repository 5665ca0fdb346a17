"""DataFrame -> DataFrame operators of the sales-mart job."""
