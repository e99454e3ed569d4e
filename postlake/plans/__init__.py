"""Page jobs, the medallion job and the registered queries."""
