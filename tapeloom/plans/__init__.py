"""Physical layout helpers: staging, dense ordering and series chunking."""
