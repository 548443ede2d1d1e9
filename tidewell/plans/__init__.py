"""Jobs: compositions of operators for one source or one table family."""
