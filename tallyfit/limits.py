"""Size bounds that choose between a broadcast and a distributed way of doing the same."""

# A lookup table is broadcast whole only below both of these.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 * 1024 * 1024

# Beyond them at most this many keys are broadcast: those that hold more than
# 1/HOT_KEYS of all rows each, of which there cannot be more than HOT_KEYS.
HOT_KEYS = 100_000

# Distinct values of one column that a string indexer may collect on the driver.
DRIVER_LABELS = 100_000

# What the partial results of a fit may take on the driver at once.
DRIVER_BYTES = 256 * 1024 * 1024

# What the rows of one partition may take where a fit holds them wider than they are stored.
TASK_BYTES = 128 * 1024 * 1024

# Columns per side of the part of a covariance matrix that one task builds at a time.
COVARIANCE_WIDTH = 1024

# Features up to which a forest may hold a row as a bin for each of them.
FOREST_WIDTH = 4096
