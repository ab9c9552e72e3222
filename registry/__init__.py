"""The queries registered with the driver, their inputs and their reference SQL."""
