"""Landing files, stored tables and the retail views over star tables."""
