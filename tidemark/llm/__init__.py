"""Training-data operators: decontamination, quality, nearest neighbours,
token counts, secrets, near-duplicates, URL and HTML filters, sharding and
source mixing. Nothing else in the library imports this subpackage."""
