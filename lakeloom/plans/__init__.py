"""Building blocks that keep a plan even when one key holds a large share of the rows."""
