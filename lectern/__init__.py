"""Analytics over document corpora on Spark: search, citations, overlap, ledgers and drift."""
