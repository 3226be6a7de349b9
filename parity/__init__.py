"""Every operator on the driver's tables, with the same job as SQL."""
