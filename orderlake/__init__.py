"""Order analytics on a layered lake: cleaning, metrics, customer segments and reports."""
