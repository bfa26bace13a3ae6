"""Transit-feed archive jobs on Spark: decode, flatten, compact, catalogue, monitor."""
